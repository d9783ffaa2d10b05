"""Aggregations, top lists and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tieproof.catalog.base import CFG, query
from tieproof.catalog.base import s_canonical, s_missing_founder, s_missing_text, s_name_key, s_norm
from tieproof.catalog.base import s_rank, s_strip, s_text
from tieproof.catalog.rules import S_TRIAGE, s_validate, triaged
from tieproof.functions import rules
from tieproof.functions.names import name_key
from tieproof.functions.pages import page_signals
from tieproof.functions.text import span_present
from tieproof.operators import graph, merge, stats

C = F.col


@query("ag_dist", "raw_records legacy_records affiliations", """
SELECT 'record' AS src, 'validation_tier' AS field, validation_tier AS value, count(*) AS n FROM raw_records GROUP BY ALL
UNION ALL SELECT 'record', 'status', status, count(*) FROM raw_records GROUP BY ALL
UNION ALL SELECT 'record', 'funding_stage', funding_stage, count(*) FROM legacy_records GROUP BY ALL
UNION ALL SELECT 'edge', 'school', school, count(*) FROM affiliations GROUP BY ALL
UNION ALL SELECT 'edge', 'role', role, count(*) FROM affiliations GROUP BY ALL""")
def ag_dist(t):
    a = stats.distribution(t.raw_records, "validation_tier", "status").select(F.lit("record").alias("src"), "*")
    b = stats.distribution(t.legacy_records, "funding_stage").select(F.lit("record").alias("src"), "*")
    c = stats.distribution(t.affiliations, "school", "role").select(F.lit("edge").alias("src"), "*")
    return a.union(b).union(c)


S_TOTALS = """SELECT count(*) AS n_records, count(*) FILTER (status = 'ipo') AS n_public,
  count(*) FILTER (status = 'acquired') AS n_acquired, count(*) FILTER (funding_total_usd <> 0) AS n_funded,
  CAST(sum(funding_total_usd) AS BIGINT) AS total_funding,
  CAST(floor(sum(funding_total_usd) / count(*) FILTER (funding_total_usd <> 0)) AS BIGINT) AS mean_funding
FROM raw_records"""


@query("ag_totals", "raw_records", S_TOTALS)
def ag_totals(t):
    return stats.totals(t.raw_records)


def overlaid(t):
    """Records under their store key, replaced by the re-extracted ones (those with evidence)."""
    r = t.raw_records.withColumn("name_key", name_key(C("company_name"))).select(
        "name_key", "rec_seq", "company_name", "validation_tier"
    )
    base = merge.first_per_key(r, "name_key", "rec_seq")
    patch = merge.last_per_key(
        t.raw_records.where("evidence <> ''").withColumn("name_key", name_key(C("company_name"))).select(
            "name_key", "rec_seq", "company_name", "validation_tier"), "name_key", "rec_seq")
    return merge.overlay(base, patch, "name_key")


S_OVERLAY = f"""
k AS (SELECT *, {s_name_key('company_name')} AS name_key FROM raw_records),
b AS (SELECT name_key, rec_seq, company_name, validation_tier FROM k
      QUALIFY row_number() OVER (PARTITION BY name_key ORDER BY rec_seq) = 1),
p AS (SELECT name_key, rec_seq, company_name, validation_tier FROM k WHERE evidence <> ''
      QUALIFY row_number() OVER (PARTITION BY name_key ORDER BY rec_seq DESC) = 1),
o AS (SELECT coalesce(p.name_key, b.name_key) AS name_key, coalesce(p.rec_seq, b.rec_seq) AS rec_seq,
   coalesce(p.company_name, b.company_name) AS company_name, coalesce(p.validation_tier, b.validation_tier) AS validation_tier,
   CASE WHEN p.name_key IS NULL THEN 'base' ELSE 'patch' END AS origin FROM b FULL JOIN p ON b.name_key = p.name_key)"""


@query("ag_origin", "raw_records", S_OVERLAY + "SELECT origin, count(*) AS n FROM o GROUP BY origin")
def ag_origin(t):
    return overlaid(t).groupBy("origin").agg(F.count("*").alias("n"))


S_DECADE = """SELECT CAST(floor(founded_year / 10) * 10 AS INTEGER) AS decade, count(*) AS n FROM raw_records
WHERE founded_year BETWEEN 1900 AND 2030 GROUP BY 1"""


@query("ag_decade", "raw_records", S_DECADE)
def ag_decade(t):
    return stats.decades(t.raw_records)


@query("ag_multi", "affiliations", """
SELECT person, count(*) AS n_companies FROM affiliations GROUP BY person HAVING count(*) > 1""")
def ag_multi(t):
    return graph.repeat_counts(t.affiliations)


S_DEGREE = """SELECT person, count(DISTINCT company) AS degree FROM affiliations GROUP BY person
ORDER BY degree DESC, person LIMIT 15"""


@query("ag_degree", "affiliations", S_DEGREE)
def ag_degree(t):
    return graph.degrees(t.affiliations).orderBy(F.desc("degree"), "person").limit(15)


S_PAIRS = """
m AS (SELECT DISTINCT company, person FROM affiliations),
w AS (SELECT a.person AS source, b.person AS target, count(*) AS weight FROM m a JOIN m b ON a.company = b.company AND a.person < b.person
  GROUP BY ALL)"""


S_REPEATED = """
m AS (SELECT DISTINCT company, person FROM affiliations)
SELECT a.person AS source, b.person AS target, count(*) AS weight, string_agg(a.company, '; ' ORDER BY a.company) AS companies
FROM m a JOIN m b ON a.company = b.company AND a.person < b.person GROUP BY ALL HAVING count(*) > 1"""


@query("ag_pair_weight", "affiliations", S_REPEATED)
def ag_pair_weight(t):
    return graph.repeated_pairs(t.affiliations)


@query("ag_repeated_pairs", "affiliations", S_REPEATED)
def ag_repeated_pairs(t):
    return graph.repeated_pairs(t.affiliations)


def dedup_columns(df, *more):
    return df.select(
        "canonical", "rec_seq", "company_name", "validation_tier", "proof_url", "n_merged", "industry", "founded_year",
        "headquarters", "status", "funding_total_usd", "employee_count", *more,
    )


S_DEDUP = f"""
g AS (SELECT *, {s_canonical('company_name')} AS canonical,
        (3 - {s_rank('validation_tier')}) * 1000000000000 + rec_seq AS o FROM raw_records),
merged AS (SELECT canonical, arg_min(rec_seq, o) AS rec_seq, arg_min(company_name, o) AS company_name,
  arg_min(validation_tier, o) AS validation_tier, arg_min(proof_url, o) AS proof_url, count(*) AS n_merged,
  arg_min(industry, o) FILTER (industry NOT IN ('', 'unknown')) AS industry,
  arg_min(founded_year, o) FILTER (founded_year IS NOT NULL) AS founded_year,
  arg_min(headquarters, o) FILTER (headquarters NOT IN ('', 'unknown')) AS headquarters,
  coalesce(arg_min(status, o) FILTER (status <> 'unknown'), 'unknown') AS status,
  max(funding_total_usd) AS funding_total_usd, max(employee_count) AS employee_count
  FROM g GROUP BY canonical, CASE WHEN canonical = '' THEN rec_seq END)"""


@query("ag_dedup_merge", "raw_records", S_DEDUP + """
SELECT merged.*, g.founder, g.evidence, g.funding_text FROM merged JOIN g ON g.rec_seq = merged.rec_seq""")
def ag_dedup_merge(t):
    return dedup_columns(merge.dedup_merge(t.raw_records), "founder", "evidence", "funding_text")


S_DEDUP_REPORT = S_DEDUP + """,
top AS (SELECT canonical, n_merged AS group_rows, validation_tier AS kept_tier FROM merged
        WHERE n_merged > 1 AND canonical <> '' ORDER BY n_merged DESC, canonical LIMIT 25)
SELECT top.canonical, company_name, count(*) AS n_rows, group_rows, kept_tier FROM g JOIN top ON top.canonical = g.canonical
GROUP BY ALL"""


@query("ag_dedup_report", "raw_records", S_DEDUP_REPORT)
def ag_dedup_report(t):
    return merge.dedup_report(t.raw_records)


#: Every column of the store in the check, written out.
STORED = (
    "company_name", "founders", "founder", "description", "proof_url", "affiliation_type", "evidence", "industry", "status",
    "founded_year", "funding_total_usd", "funding_stage", "employee_count", "is_public", "headquarters", "exit_year", "acquirer",
    "source_url", "source_credibility", "acquisition_amount_usd",
)


def s_upsert(src: str, key: str = "name_key") -> str:
    """Merged store rows in SQL: first real value, else the last vague one, else the first."""
    def pick(f: str, text_type: bool = True) -> str:
        t = f"CAST({f} AS VARCHAR)"
        truthy = f"{f} IS NOT NULL AND {t} NOT IN ('', '0', 'false')"
        return (
            f"coalesce(arg_min({f}, rec_seq) FILTER ({truthy} AND {t} NOT IN ('Unknown', 'unknown')), "
            f"arg_max({f}, rec_seq) FILTER ({truthy}), arg_min({f}, rec_seq) FILTER ({f} IS NOT NULL)) AS {f}"
        )

    fields = ", ".join(pick(f) for f in STORED)
    return f"""
store AS (SELECT {key}, min(rec_seq) AS rec_seq, count(*) AS n_merged, {fields},
  count(DISTINCT CASE WHEN source_url <> '' THEN source_url END) AS n_sources,
  bool_or(verified) OR count(DISTINCT CASE WHEN source_url <> '' THEN source_url END) >= 2 AS verified
  FROM {src} GROUP BY {key})"""


STORE_OUT = (
    "name_key", "rec_seq", "n_merged", "company_name", "founders", "founder", "description", "proof_url",
    "affiliation_type", "evidence", "status", "founded_year", "funding_total_usd", "funding_stage",
    "employee_count", "is_public", "headquarters", "exit_year", "acquirer", "acquisition_amount_usd", "source_url", "n_sources", "verified",
)


@query("ag_upsert_merge", "legacy_records", f"k AS (SELECT *, {s_name_key('company_name')} AS name_key FROM legacy_records),"
       + s_upsert("k") + f"SELECT {', '.join(STORE_OUT)} FROM store")
def ag_upsert_merge(t):
    keyed = t.legacy_records.withColumn("name_key", name_key(C("company_name")))
    return merge.upsert_merge(keyed).select(*STORE_OUT)


_CF = ", ".join(f"('{f}', CAST({f} AS VARCHAR))" for f in (
    "description", "industry", "funding_total_usd", "funding_stage", "founded_year", "employee_count", "is_public", "headquarters",
    "status", "exit_year", "acquirer", "acquisition_amount_usd"))


@query("ag_conflicts", "legacy_records", f"""
k AS (SELECT *, {s_name_key('company_name')} AS name_key FROM legacy_records),
l AS (SELECT name_key, rec_seq, field, value FROM k, LATERAL (VALUES {_CF}) AS v(field, value)
      WHERE value IS NOT NULL AND value NOT IN ('', 'unknown')),
f AS (SELECT name_key, field, arg_min(value, rec_seq) AS kept FROM l GROUP BY ALL)
SELECT l.name_key, l.field, kept, value AS rejected, count(*) AS n FROM l JOIN f ON f.name_key = l.name_key AND f.field = l.field
WHERE value <> kept AND value NOT IN ('0', 'false') AND kept NOT IN ('0', 'false') GROUP BY ALL""")
def ag_conflicts(t):
    return merge.conflicts(t.legacy_records.withColumn("name_key", name_key(C("company_name"))))


S_GAP = f"""
g AS (SELECT rec_seq, company_name, {s_missing_founder('founder', 'affiliation_type')} AS no_founder,
  {s_missing_text('proof_url')} AS no_proof, {s_missing_text('description')} AS no_description, NOT verified AS unverified
  FROM legacy_records),
counts AS (SELECT count(*) AS total, count(*) FILTER (no_founder) AS missing_founders,
  count(*) FILTER (no_proof) AS missing_proof_url, count(*) FILTER (no_description) AS missing_description,
  count(*) FILTER (unverified) AS unverified,
  count(*) - count(DISTINCT CASE WHEN no_founder OR no_proof OR no_description THEN company_name END) AS complete_count FROM g),
gap_names AS (SELECT rec_seq, company_name, 'missing_founders' AS gap FROM g WHERE no_founder
  UNION ALL SELECT rec_seq, company_name, 'missing_proof_url' FROM g WHERE no_proof
  UNION ALL SELECT rec_seq, company_name, 'missing_description' FROM g WHERE no_description
  UNION ALL SELECT rec_seq, company_name, 'unverified' FROM g WHERE unverified)"""


@query("ag_gap", "legacy_records", S_GAP + "SELECT * FROM counts")
def ag_gap(t):
    return stats.gap_counts(t.legacy_records)


@query("ag_gap_names", "legacy_records", S_GAP + "SELECT * FROM gap_names")
def ag_gap_names(t):
    return stats.gap_names(t.legacy_records)


@query("ag_summary", "legacy_records", """
x AS (SELECT CASE WHEN industry = '' THEN 'Unknown' ELSE industry END AS industry,
  CASE WHEN affiliation_type = '' THEN 'Unknown' ELSE affiliation_type END AS affiliation_type, status FROM legacy_records),
i AS (SELECT 'industry' AS field, industry AS value, count(*) AS n FROM x GROUP BY ALL ORDER BY n DESC, value LIMIT 15)
SELECT * FROM i UNION ALL SELECT 'affiliation_type', affiliation_type, count(*) FROM x GROUP BY ALL
UNION ALL SELECT 'status', status, count(*) FROM x GROUP BY ALL""")
def ag_summary(t):
    return stats.summary(t.legacy_records)


S_SHIFT = s_validate("legacy_records") + """
, p AS (SELECT validation_tier AS b, tier AS a, count(*) AS n FROM validated GROUP BY ALL)
SELECT x AS tier, CAST(coalesce((SELECT sum(n) FROM p WHERE b = x), 0) AS BIGINT) AS before,
  CAST(coalesce((SELECT sum(n) FROM p WHERE a = x), 0) AS BIGINT) AS after,
  CAST(coalesce((SELECT sum(n) FROM p WHERE a = x AND b <> x), 0) AS BIGINT) AS changed_to
FROM (SELECT DISTINCT b AS x FROM p UNION SELECT DISTINCT a FROM p)"""


@query("ag_tier_shift", "legacy_records", S_SHIFT)
def ag_tier_shift(t):
    old = t.legacy_records.withColumn("old_tier", C("validation_tier"))
    return stats.tier_shift(rules.validate(old, CFG), "old_tier", "validation_tier")


S_ROUND = """
c AS (SELECT round, count(*) AS calls, """ + ", ".join(
    f"count(*) FILTER (outcome = '{o}') AS {o}" for o in stats.CALL_OUTCOMES) + """,
  CAST(floor(sum(latency_ms) / count(*)) AS BIGINT) AS avg_latency_ms,
  round_even(100.0 * count(*) FILTER (outcome = 'parsed') / count(*), 0) AS parsed_pct FROM call_log GROUP BY round),
f AS (SELECT round, count(*) AS fetches, count(*) FILTER (outcome = 'empty') AS empty_fetches,
  round(100.0 * count(*) FILTER (outcome = 'empty') / count(*), 1) AS empty_pct FROM fetch_log GROUP BY round)
SELECT * FROM c FULL JOIN f USING (round)"""


@query("ag_round", "call_log fetch_log", S_ROUND)
def ag_round(t):
    return stats.round_metrics(t.call_log, t.fetch_log)


@query("ag_bucket_pct", "raw_records", f"""
x AS ({S_TRIAGE})
SELECT bucket, count(*) AS n, CAST(floor(count(*) * 100 / (SELECT count(*) FROM x)) AS BIGINT) AS pct,
  CASE bucket {' '.join(f"WHEN '{b}' THEN {i + 1}" for i, b in enumerate(rules.TRIAGE_ORDER))} END AS position
FROM x GROUP BY bucket""")
def ag_bucket_pct(t):
    return stats.bucket_percent(triaged(t.raw_records))


@query("ag_verdict_tally", "verdict_lines", """
v AS (SELECT doc_id, arg_max(verdict, seq) AS verdict FROM verdict_lines GROUP BY doc_id)
SELECT coalesce(v.verdict, 'UNADJUDICATED') AS verdict, count(*) AS n FROM documents d LEFT JOIN v ON v.doc_id = d.doc_id
GROUP BY 1""")
def ag_verdict_tally(t):
    from tieproof.operators.joins import with_verdict

    return with_verdict(t.documents.select("doc_id"), t.verdict_lines, "doc_id", "seq").groupBy("verdict").agg(
        F.count("*").alias("n")).orderBy(F.desc("n"), "verdict")


@query("ag_span_rate", "claims", f"""
m AS (SELECT lang, doc_id, {s_strip(s_text('span'))} <> '' AND contains({s_norm('source_text')}, {s_norm('span')}) AS ok FROM claims),
r AS (SELECT lang, doc_id, count(*) AS n, count(*) FILTER (ok) AS good FROM m GROUP BY ALL)
SELECT lang, count(*) AS n_records, count(*) FILTER (good > 0) AS survived, count(*) FILTER (good = 0) AS dropped,
  round(avg(good / n), 3) AS avg_match FROM r GROUP BY lang""")
def ag_span_rate(t):
    return stats.span_rates(t.claims, span_present(C("span"), C("source_text")), "lang", "doc_id")


@query("ag_span_samples", "claims", f"""
m AS (SELECT lang, doc_id, span AS sample,
  {s_strip(s_text('span'))} <> '' AND contains({s_norm('source_text')}, {s_norm('span')}) AS ok FROM claims)
SELECT lang, ok, doc_id, sample FROM m
QUALIFY row_number() OVER (PARTITION BY lang, ok ORDER BY doc_id) <= CASE WHEN ok THEN 3 ELSE 5 END""")
def ag_span_samples(t):
    from tieproof.operators.joins import span_samples

    return span_samples(t.claims, span_present(C("span"), C("source_text")))


@query("ag_probe_summary", "", """
SELECT regexp_extract(url, '^https?://([^/?#]*)', 1) AS target, count(*) AS total,
  count(*) FILTER (NOT regexp_matches(html, '(?i)(captcha|are you a robot|verify (?:you are|that you))')) AS clean,
  count(*) FILTER (regexp_matches(html, '(?i)<title[^>]*>([^<]+)</title>')) AS titled FROM pages GROUP BY 1""")
def ag_probe_summary(t):
    s = page_signals(C("html"), C("url"))
    return t.pages.groupBy(F.regexp_extract("url", "^https?://([^/?#]*)", 1).alias("target")).agg(
        F.count("*").alias("total"), F.count_if(~s["captcha"]).alias("clean"),
        F.count_if(s["page_title"].isNotNull()).alias("titled"),
    )


@query("ag_store_stats", "raw_records affiliations fetch_log", """
SELECT 'companies' AS what, '' AS tier, count(*) AS n FROM raw_records
UNION ALL SELECT 'affiliations', '', count(*) FROM affiliations
UNION ALL SELECT 'query_log', '', count(*) FROM fetch_log
UNION ALL SELECT 'companies_by_tier', validation_tier, count(*) FROM raw_records GROUP BY validation_tier""")
def ag_store_stats(t):
    def count(df, what):
        return df.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), F.lit("").alias("tier"), "n")

    tiers = t.raw_records.groupBy(C("validation_tier").alias("tier")).agg(F.count("*").alias("n"))
    return count(t.raw_records, "companies").union(count(t.affiliations, "affiliations")).union(
        count(t.fetch_log, "query_log")).union(tiers.select(F.lit("companies_by_tier").alias("what"), "tier", "n"))


@query("ag_engine_health", "fetch_log", """
x AS (SELECT * FROM fetch_log QUALIFY row_number() OVER (PARTITION BY path ORDER BY ts DESC, event_id DESC) <= 50)
SELECT path, count(*) AS n, round(avg(CASE WHEN outcome = 'ok' THEN 1.0 ELSE 0.0 END), 3) AS success_rate,
  round(quantile_cont(CAST(latency_ms AS DOUBLE), 0.5), 3) AS p50, round(quantile_cont(CAST(latency_ms AS DOUBLE), 0.95), 3) AS p95 FROM x GROUP BY path""")
def ag_engine_health(t):
    return stats.engine_health(t.fetch_log)


# --- top lists -------------------------------------------------------------------


@query("tk_funded", "raw_records", """
SELECT company_name, funding_total_usd, status, rec_seq FROM raw_records WHERE funding_total_usd <> 0
ORDER BY funding_total_usd DESC, company_name DESC, status DESC, rec_seq DESC LIMIT 20""")
def tk_funded(t):
    keys = ("funding_total_usd", "company_name", "status", "rec_seq")
    return t.raw_records.where("funding_total_usd <> 0").select(*keys).orderBy(*[F.desc(k) for k in keys]).limit(20)


@query("tk_acquired", "legacy_records", """
SELECT company_name, acquisition_amount_usd, CASE WHEN acquirer = '' THEN '?' ELSE acquirer END AS acquirer, rec_seq
FROM legacy_records WHERE acquisition_amount_usd <> 0 ORDER BY 2 DESC, 1 DESC, 3 DESC, 4 DESC LIMIT 10""")
def tk_acquired(t):
    keys = ("acquisition_amount_usd", "company_name", "acquirer", "rec_seq")
    df = t.legacy_records.where("acquisition_amount_usd <> 0").withColumn(
        "acquirer", F.when(C("acquirer") == "", "?").otherwise(C("acquirer")))
    return df.select(*keys).orderBy(*[F.desc(k) for k in keys]).limit(10)


S_FREQUENT = S_PAIRS + """,
a1 AS (SELECT 'industry' AS kind, industry AS value, count(*) AS n FROM raw_records GROUP BY ALL ORDER BY n DESC, value LIMIT 20),
a2 AS (SELECT 'place', headquarters AS value, count(*) AS n FROM raw_records GROUP BY ALL ORDER BY n DESC, value LIMIT 15),
a3 AS (SELECT 'pair', concat(source, ' + ', target) AS value, weight FROM w ORDER BY weight DESC, source, target LIMIT 15),
a4 AS (SELECT 'person', person AS value, count(*) AS n FROM affiliations GROUP BY ALL HAVING count(*) > 1 ORDER BY n DESC, value LIMIT 25)
SELECT * FROM a1 UNION ALL SELECT * FROM a2 UNION ALL SELECT * FROM a3 UNION ALL SELECT * FROM a4"""


def frequent(t):
    def top(df, kind, value, n, k):
        return df.select(F.lit(kind).alias("kind"), C(value).alias("value"), C(n).alias("n")).orderBy(
            F.desc("n"), "value").limit(k)

    pairs = graph.top_pairs(t.affiliations, 15).withColumn("pair", F.concat("source", F.lit(" + "), "target"))
    return (
        top(stats.top_counts(t.raw_records, "industry", 20), "industry", "industry", "n", 20)
        .union(top(stats.top_counts(t.raw_records, "headquarters", 15), "place", "headquarters", "n", 15))
        .union(top(pairs, "pair", "pair", "weight", 15))
        .union(top(graph.repeat_counts(t.affiliations), "person", "person", "n_companies", 25))
    )


@query("tk_frequent", "raw_records affiliations", S_FREQUENT)
def tk_frequent(t):
    return frequent(t)


@query("tk_suspicion", "legacy_records", """
SELECT rec_seq, company_name, CAST((founders IN ('', 'Unknown')) AS INTEGER) + CAST((proof_url = '') AS INTEGER)
  + CAST((description = '') AS INTEGER) AS score FROM legacy_records WHERE NOT verified AND evidence = ''
ORDER BY score DESC, rec_seq LIMIT 20""")
def tk_suspicion(t):
    return stats.suspicion(t.legacy_records)


@query("tk_gap_targets", "legacy_records", S_GAP + """
, p AS (SELECT company_name, min(CASE WHEN no_founder AND no_proof THEN 1 WHEN no_founder THEN 2 WHEN no_proof THEN 3 END) AS priority
        FROM g GROUP BY company_name)
SELECT company_name, priority FROM p WHERE priority IS NOT NULL ORDER BY priority, company_name LIMIT 15""")
def tk_gap_targets(t):
    return stats.gap_targets(t.legacy_records)


@query("tk_first_per_key", "replies", """
x AS (SELECT event_id, TRY_CAST(regexp_extract(reply, '"k": (\\d+)', 1) AS INTEGER) AS k FROM replies)
SELECT k, min(event_id) AS event_id, count(*) AS n FROM x WHERE k IS NOT NULL GROUP BY k""")
def tk_first_per_key(t):
    k = F.regexp_extract("reply", r'"k": (\d+)', 1).try_cast("int")
    rows = t.replies.select("event_id", k.alias("k")).where("k IS NOT NULL")
    return rows.groupBy("k").agg(F.min("event_id").alias("event_id"), F.count("*").alias("n"))


@query("tk_last_per_key", "call_log", """
SELECT session_id, arg_max(event_id, event_id) AS event_id, arg_max(outcome, event_id) AS outcome,
  arg_max(latency_ms, event_id) AS latency_ms FROM call_log GROUP BY session_id""")
def tk_last_per_key(t):
    return merge.last_per_key(t.call_log.select("session_id", "event_id", "outcome", "latency_ms"), "session_id", "event_id")


# --- sets ------------------------------------------------------------------------


@query("so_union_lists", "affiliations", """
SELECT company, school AS value, min(pos) AS pos FROM affiliations WHERE school <> '' GROUP BY ALL""")
def so_union_lists(t):
    from tieproof.operators.lists import union_values

    return union_values(t.affiliations, "company", "school", "pos")


@query("so_union_by_name", "affiliations", """
SELECT company, person, pos, role, school FROM affiliations WHERE person <> ''
QUALIFY row_number() OVER (PARTITION BY company, person ORDER BY pos, role, school) = 1""")
def so_union_by_name(t):
    from tieproof.operators.lists import union_by_name

    return union_by_name(t.affiliations, "company", "person", "pos", ["role", "school"])


@query("so_both_only", "legacy_records", S_GAP + """
, n AS (SELECT company_name, bool_or(no_founder) AS f, bool_or(no_proof) AS p FROM g GROUP BY company_name)
SELECT company_name, CASE WHEN f AND p THEN 'both' WHEN f THEN 'founder only' ELSE 'url only' END AS kind FROM n WHERE f OR p""")
def so_both_only(t):
    from tieproof.operators.lists import both_or_only

    g = stats.gap_flags(t.legacy_records)
    return both_or_only(g, "company_name", "no_founder", "no_proof", ("founder only", "url only"))


@query("so_union_missing", "legacy_records", S_GAP + """
SELECT count(DISTINCT company_name) AS n FROM g WHERE no_founder OR no_proof OR no_description""")
def so_union_missing(t):
    g = stats.gap_flags(t.legacy_records)
    return g.where("no_founder OR no_proof OR no_description").agg(F.count_distinct("company_name").alias("n"))


@query("so_manifest_diff", "visits", """
SELECT DISTINCT substr(sha256(url), 1, 16) AS url_key FROM pages EXCEPT SELECT substr(sha256(url), 1, 16) FROM visits""")
def so_manifest_diff(t):
    from tieproof.functions.urls import url_key

    listed, present = t.pages.select(url_key(C("url")).alias("url_key")), t.visits.select(url_key(C("url")).alias("url_key"))
    return listed.subtract(present)


@query("so_append", "raw_records", f"""
x AS ({S_TRIAGE})
SELECT company_name, rec_seq, 'NONCOMPANY' AS verdict, true AS rule_dropped, reason AS why, CAST(NULL AS VARCHAR) AS evidence
FROM x WHERE bucket IN ('reject:own-entity', 'reject:investment')
UNION ALL SELECT x.company_name, x.rec_seq, 'UNCLEAR', NULL, NULL, r.evidence FROM x JOIN raw_records r ON r.rec_seq = x.rec_seq
WHERE bucket NOT IN ('reject:own-entity', 'reject:investment')""")
def so_append(t):
    from tieproof.operators.joins import append_logs, rule_dropped

    dropped, pending = rule_dropped(triaged(t.raw_records))
    judged = pending.select("company_name", "rec_seq", F.lit("UNCLEAR").alias("verdict"), "evidence")
    return append_logs(dropped, judged)


__all__ = ["S_OVERLAY", "overlaid", "S_GAP", "S_DEDUP", "S_DEDUP_REPORT", "s_upsert", "STORE_OUT"]

"""Joins, and the columns computed on joined signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from tieproof.catalog.base import CFG, lit, query
from tieproof.catalog.base import in_list, s_canonical, s_domain, s_entity, s_get, s_last_name, s_name_key, s_netloc
from tieproof.catalog.base import s_norm, s_strip, s_text, s_tie, s_tier
from tieproof.catalog.rules import S_TRIAGE, triaged
from tieproof.functions import names, rules, scoring, urls
from tieproof.functions.text import span_present
from tieproof.operators import enrich, graph, joins
from tieproof.plans import gate

C = F.col


@query("jn_verdict", "verdict_lines", """
v AS (SELECT doc_id, arg_max(verdict, seq) AS verdict FROM verdict_lines GROUP BY doc_id)
SELECT d.doc_id, coalesce(v.verdict, 'UNADJUDICATED') AS verdict FROM documents d LEFT JOIN v ON v.doc_id = d.doc_id""")
def jn_verdict(t):
    return joins.with_verdict(t.documents.select("doc_id"), t.verdict_lines, "doc_id", "seq")


@query("jn_recovery", "verdict_log recovery_log raw_records", """
lines AS (SELECT seq, company_name, verdict FROM verdict_log
  UNION ALL SELECT seq - 1000000000, company_name, 'FOUNDER' FROM verdict_log WHERE seq % 3 = 0),
a AS (SELECT company_name, arg_max(verdict, seq) AS verdict FROM lines GROUP BY 1),
b AS (SELECT company_name, arg_max(verdict, seq) AS verdict FROM recovery_log GROUP BY 1)
SELECT r.rec_seq, r.company_name, coalesce(b.verdict, a.verdict) AS verdict FROM raw_records r
LEFT JOIN a ON a.company_name = r.company_name LEFT JOIN b ON b.company_name = r.company_name""")
def jn_recovery(t):
    earlier = t.verdict_log.where("seq % 3 = 0").select(
        (C("seq") - 1_000_000_000).alias("seq"), "company_name", F.lit("FOUNDER").alias("verdict"))
    return joins.effective_verdict(
        t.raw_records.select("rec_seq", "company_name"), t.verdict_log.unionByName(earlier), t.recovery_log, "company_name", "seq"
    ).select("rec_seq", "company_name", "verdict")


_W = CFG.signal_weights
S_GATE = f"""
reg AS (SELECT lookup_name, arg_min(detail, reg_seq) AS detail FROM registry GROUP BY lookup_name),
edge AS (SELECT DISTINCT company, {s_last_name('founder')} AS last FROM bindings),
sig AS (SELECT r.*, coalesce(b.verdict, a.verdict) AS verdict, e.company IS NOT NULL AS api_confirmed,
    {s_entity('r.company_name')} AS rule_type, reg.detail AS reg_detail, {s_tier('proof_url')} AS source_tier,
    {s_tie('affiliation_type')} AS tie
  FROM legacy_records r LEFT JOIN verdict_log a ON a.company_name = r.company_name
  LEFT JOIN recovery_log b ON b.company_name = r.company_name
  LEFT JOIN edge e ON e.company = r.company_name AND e.last = {s_last_name('r.founder')} AND e.last <> ''
  LEFT JOIN reg ON reg.lookup_name = lower(trim(r.company_name))),
sig2 AS (SELECT *, CASE WHEN rule_type <> 'unknown' THEN false WHEN reg_detail IS NOT NULL THEN true END AS company_real,
    CASE WHEN rule_type <> 'unknown' THEN rule_type WHEN reg_detail IS NOT NULL THEN 'company' ELSE 'unknown' END AS entity_type,
    CASE WHEN rule_type <> 'unknown' THEN 'name-rule' ELSE 'registry' END AS source,
    CASE WHEN rule_type <> 'unknown' THEN '' ELSE coalesce(reg_detail, 'no registration match') END AS detail FROM sig),
sc AS (SELECT *,
    CASE WHEN source_tier = 'directory' THEN {_W['directory']}::DOUBLE ELSE 0.0::DOUBLE END
    + CASE WHEN api_confirmed THEN {_W['api']}::DOUBLE ELSE 0.0::DOUBLE END
    + CASE WHEN api_confirmed THEN {_W['extra_source']}::DOUBLE ELSE 0.0::DOUBLE END
    + CASE WHEN tie = 'strong' THEN {_W['strong_tie']}::DOUBLE ELSE 0.0::DOUBLE END
    + CASE WHEN verdict = 'FOUNDER' THEN {_W['verdict']}::DOUBLE ELSE 0.0::DOUBLE END AS total,
    list_filter([CASE WHEN source_tier = 'directory' THEN 'directory-source' END, CASE WHEN api_confirmed THEN 'api-confirmed' END,
      CASE WHEN api_confirmed THEN 'corroborations=2' END, CASE WHEN tie = 'strong' THEN 'strong-tie' END,
      CASE WHEN verdict = 'FOUNDER' THEN 'verdict-founder' END,
      CASE WHEN api_confirmed THEN 'structured-agreement' END], lambda x: x IS NOT NULL) AS prov FROM sig2),
co AS (SELECT *, CASE WHEN api_confirmed THEN greatest(least(1.0::DOUBLE, total), {CFG.publish_threshold}::DOUBLE)
    ELSE least(1.0::DOUBLE, total) END AS raw_conf,
    NOT ({s_last_name('founder')} = '' OR contains(lower(evidence), {s_last_name('founder')})
      OR {s_get('evidence', scoring.FOUNDER_PHRASE, 0, '(?i)')} = ''
      OR contains(lower({s_get('evidence', scoring.FOUNDER_PHRASE, 0, '(?i)')}), {s_last_name('founder')})) AS contradiction FROM sc),
ga AS (SELECT *, round(raw_conf, 3) AS confidence, raw_conf >= {CFG.publish_threshold} OR api_confirmed AS publishable FROM co),
gated AS (SELECT *, CASE WHEN contradiction THEN 'needs_human'
    WHEN entity_type IN {in_list(scoring.NON_COMPANY_TYPES)} OR coalesce(company_real = false, false) THEN 'rejected'
    WHEN tie = 'none' THEN 'rejected' WHEN verdict IN {in_list(scoring.NON_FOUNDER_VERDICTS)} THEN 'rejected'
    WHEN confidence >= {CFG.publish_threshold} AND (verdict IS NULL OR verdict = 'FOUNDER') THEN 'verified'
    ELSE 'needs_human' END AS state,
  CASE WHEN contradiction THEN 'founder/evidence contradiction'
    WHEN entity_type IN {in_list(scoring.NON_COMPANY_TYPES)} OR coalesce(company_real = false, false)
      THEN concat('not-a-company (', entity_type, ')')
    WHEN tie = 'none' THEN 'no institution tie'
    WHEN verdict IN {in_list(scoring.NON_FOUNDER_VERDICTS)} THEN concat('role=', lower(verdict))
    WHEN confidence >= {CFG.publish_threshold} AND (verdict IS NULL OR verdict = 'FOUNDER') THEN 'founding confirmed'
    ELSE concat('insufficient confidence (', CAST(confidence AS VARCHAR), ')') END AS reason,
  CASE WHEN company_real = true OR api_confirmed THEN true WHEN company_real = false THEN false END AS entity_verified,
  CASE WHEN company_real = true THEN concat('entity confirmed (', source, ')')
    WHEN api_confirmed THEN 'entity confirmed (graph)'
    WHEN company_real = false THEN concat('flagged non-company (', entity_type, ', name-rule)')
    ELSE 'entity UNVERIFIED -- no registry/graph match (not disqualifying)' END AS entity_note,
  concat(printf('%.2f', confidence), ' | ', array_to_string(prov, '; ')) AS confidence_provenance,
  array_to_string(prov, '; ') AS provenance, {s_domain('proof_url')} AS source_domain FROM ga)
"""
GATE_SHAPES = "legacy_records verdict_log recovery_log bindings registry"


def gated(t):
    return gate.gate(t.legacy_records, t.verdict_log, t.recovery_log, t.bindings, t.registry, CFG).withColumn(
        "provenance", F.array_join("provenance", "; "))


def gate_query(name: str, *cols: str):
    @query(name, GATE_SHAPES, S_GATE + f"SELECT {', '.join(('rec_seq',) + cols)} FROM gated")
    def run(t):
        return gated(t).select("rec_seq", *cols)

    return run


@query("jn_signals", GATE_SHAPES, S_GATE + """
SELECT rec_seq, company_name, verdict, api_confirmed, company_real, entity_type, source, detail, source_tier, tie FROM gated""")
def jn_signals(t):
    return gate.signals(t.legacy_records, t.verdict_log, t.recovery_log, t.bindings, t.registry, CFG).select(
        "rec_seq", "company_name", "verdict", "api_confirmed", "company_real", "entity_type", "source", "detail",
        "source_tier", "tie")


gate_query("sc_confidence", "confidence", "publishable", "provenance")
gate_query("sc_contradiction", "founder", "evidence", "contradiction")
gate_query("sc_decide", "state", "reason")
gate_query("sc_entity_note", "entity_verified", "entity_note")


@query("sc_source_tier", "raw_records", f"""
SELECT 'record' AS src, rec_seq AS n, {s_tier('proof_url')} AS source_tier FROM raw_records
UNION ALL SELECT 'page', page_id, {s_tier('url')} FROM pages""")
def sc_source_tier(t):
    def part(df, src, key, url):
        return df.select(F.lit(src).alias("src"), C(key).alias("n"), scoring.source_tier(C(url), CFG).alias("source_tier"))

    return part(t.raw_records, "record", "rec_seq", "proof_url").union(part(t.pages, "page", "page_id", "url"))


@query("sc_tie", "legacy_records", f"SELECT rec_seq, affiliation_type, {s_tie('affiliation_type')} AS tie FROM legacy_records")
def sc_tie(t):
    return t.legacy_records.select("rec_seq", "affiliation_type", scoring.tie(C("affiliation_type")).alias("tie"))


gate_query("sc_provenance_text", "confidence_provenance")


@query("jn_confirm_edge", "raw_records bindings", f"""
SELECT rec_seq, company_name AS company, r.founder AS person FROM raw_records r WHERE {s_last_name('r.founder')} <> ''
AND EXISTS (SELECT 1 FROM bindings b WHERE b.company = r.company_name AND {s_last_name('b.founder')} = {s_last_name('r.founder')})""")
def jn_confirm_edge(t):
    edges = t.raw_records.select("rec_seq", C("company_name").alias("company"), C("founder").alias("person"))
    return joins.confirmed_edges(edges, t.bindings)


@query("jn_registry", GATE_SHAPES, S_GATE + "SELECT rec_seq, company_name, company_real, entity_type, source, detail FROM sig2")
def jn_registry(t):
    return joins.registry_check(
        t.raw_records, t.registry, rules.entity_type(C("company_name"), CFG)
    ).select("rec_seq", "company_name", "company_real", "entity_type", "source", "detail")


S_NEW = f"""
fresh AS (SELECT DISTINCT title FROM titles WHERE NOT starts_with(title, 'List of') AND NOT starts_with(title, 'Category:')
  AND NOT contains(title, ' (disambiguation)')),
new_titles AS (SELECT title FROM fresh WHERE {s_canonical('title', names.FORM_WORDS_SHORT)} NOT IN
  (SELECT {s_canonical('company_name', names.FORM_WORDS_SHORT)} FROM raw_records))"""


@query("jn_new_only", "titles raw_records", S_NEW + "SELECT title FROM new_titles")
def jn_new_only(t):
    from tieproof.plans.discover import new_titles

    return new_titles(t.titles, t.raw_records)


@query("jn_resume", "", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def jn_resume(t):
    return t.documents.select("doc_id", "lang").join(t.labels.select("doc_id"), "doc_id", "left_anti")


@query("jn_unclear_pages", "verdicts", """
SELECT v.doc_id, coalesce(CASE WHEN p.text <> '' THEN p.text END, concat('evidence ', v.doc_id)) AS page_text
FROM verdicts v LEFT JOIN documents p ON p.doc_id = v.doc_id WHERE v.verdict = 'UNCLEAR'""")
def jn_unclear_pages(t):
    v = t.verdicts.withColumn("evidence", F.concat(F.lit("evidence "), C("doc_id")))
    return joins.pages_to_recheck(v, t.documents, "doc_id").select("doc_id", "page_text")


_URL = "concat('https://page.example.net/', CAST(CAST(floor(rec_seq / 24) AS BIGINT) AS STRING))"


@query("jn_match_back", "raw_records", f"""
w AS (SELECT rec_seq, company_name, CASE WHEN rec_seq % 11 = 0 THEN '' ELSE {_URL} END AS url FROM raw_records),
x AS (SELECT {_URL} AS url, upper(company_name) AS found_name, rec_seq AS pos FROM raw_records
      WHERE validation_tier <> 'weak' AND evidence <> ''),
m AS (SELECT url, {s_name_key('found_name')} AS k, min(pos) AS match_pos FROM x GROUP BY ALL),
f AS (SELECT url, string_agg(found_name, '; ' ORDER BY pos) AS found FROM x GROUP BY url)
SELECT rec_seq, w.company_name, match_pos, CASE WHEN w.url = '' THEN 'fetch_failed'
    WHEN rec_seq % 11 <> 0 AND CAST(floor(rec_seq / 24) AS BIGINT) % 9 = 4 THEN 'schema_failed' WHEN match_pos IS NOT NULL THEN 'ok' ELSE 'unmatched' END AS status,
  CASE WHEN w.url <> '' AND match_pos IS NULL AND CAST(floor(rec_seq / 24) AS BIGINT) % 9 <> 4 THEN coalesce(found, '') END AS found
FROM w LEFT JOIN m ON m.url = w.url AND m.k = {s_name_key('w.company_name')} LEFT JOIN f ON f.url = w.url""")
def jn_match_back(t):
    page = F.concat(F.lit("https://page.example.net/"), F.floor(C("rec_seq") / 24).cast("string"))
    wanted = t.raw_records.select(
        "rec_seq", "company_name", F.when(C("rec_seq") % 11 == 0, "").otherwise(page).alias("url"))
    found = t.raw_records.where("validation_tier <> 'weak' AND evidence <> ''").select(
        page.alias("url"), F.upper("company_name").alias("found_name"), C("rec_seq").alias("pos"))
    failed = t.raw_records.where(F.floor(C("rec_seq") / 24) % 9 == 4).select(page.alias("url"))
    return joins.match_back(wanted, found, names.name_key(C("company_name")), failed=failed).select(
        "rec_seq", "company_name", "match_pos", "status", "found")


_KW = " OR ".join(
    f"contains(lower(concat(description, ' ', extract)), {lit(w)})" for w in enrich.COMPANY_WORDS)
_SHORT = f"trim(regexp_replace(trim(company_name), {lit('(?i)' + enrich.LEGAL_FORM_END)}, ''))"
_VARIANTS = ", ".join(f"concat({n}, {lit(v)})" for v in enrich.TITLE_VARIANTS for n in ("trim(company_name)", _SHORT))
S_VARIANTS = f"""
n AS (SELECT DISTINCT company_name FROM raw_records WHERE trim(company_name) <> ''),
v AS (SELECT company_name, unnest([{_VARIANTS}]) AS title, generate_subscripts([{_VARIANTS}], 1) - 1 AS variant FROM n),
a AS (SELECT * FROM articles WHERE type <> 'disambiguation' QUALIFY row_number() OVER (PARTITION BY title ORDER BY article_id) = 1),
hit AS (SELECT v.company_name, v.variant, a.*, ({_KW}) AS about_company FROM v JOIN a ON a.title = v.title
  QUALIFY row_number() OVER (PARTITION BY v.company_name ORDER BY ({_KW}) DESC, v.variant) = 1)"""


@query("jn_variants", "raw_records articles", S_VARIANTS + """
SELECT company_name, CAST(variant AS INTEGER) AS variant, title, article_id, about_company FROM hit""")
def jn_variants(t):
    return enrich.find_articles(t.raw_records, t.articles).select(
        "company_name", "variant", "title", "article_id", "about_company")


S_EVIDENCE = f"""
kept AS (SELECT doc_id, {s_strip(s_text('span'))} <> '' AND contains({s_norm('source_text')}, {s_norm('span')}) AS kept FROM claims)"""


@query("jn_evidence", "claims", S_EVIDENCE + "SELECT doc_id, kept FROM kept")
def jn_evidence(t):
    return t.claims.select("doc_id", span_present(C("span"), C("source_text")).alias("kept"))


_PATTERN_HOST = f"lower({s_netloc('url')})"
_TIER_ROWS = ", ".join(f"({lit(p)}, {v})" for p, v in CFG.source_tiers.items())


@query("jn_pattern_tier", "", f"""
p(pattern, tier) AS (VALUES {_TIER_ROWS}),
h AS (SELECT page_id, {_PATTERN_HOST} AS host FROM pages)
SELECT page_id, host, coalesce((SELECT arg_max(tier, length(pattern)) FROM p WHERE contains(h.host, p.pattern)), {CFG.default_source_tier}) AS tier FROM h""")
def jn_pattern_tier(t):
    rows = [f"('{p}', {v})" for p, v in CFG.source_tiers.items()]
    patterns = t.spark.sql("SELECT * FROM VALUES " + ", ".join(rows) + " AS p(pattern, tier)")
    return joins.pattern_tiers(
        t.pages.select("page_id", "url"), patterns, F.lower(urls.netloc(C("url"))), CFG.default_source_tier
    ).select("page_id", "host", "tier")


S_REJECTS = """
rejects AS (SELECT r.company_name, r.rec_seq, coalesce(v.verdict, 'UNADJUDICATED') AS verdict FROM raw_records r
  LEFT JOIN verdict_log v ON v.company_name = r.company_name WHERE coalesce(v.verdict, '') <> 'FOUNDER')"""


@query("jn_why_excluded", "raw_records verdict_log", S_REJECTS + """
SELECT a.rec_seq AS asked, concat(' ', upper(a.company_name)) AS company_name, j.company_name AS rejected_name, j.rec_seq, j.verdict
FROM raw_records a JOIN rejects j ON lower(trim(j.company_name)) = lower(a.company_name)""")
def jn_why_excluded(t):
    rejects = gate.apply_verdicts(t.legacy_records, t.verdict_log).where("action = 'rejected'").select(
        "company_name", "rec_seq", "verdict")
    asked = t.raw_records.select(C("rec_seq").alias("asked"), F.concat(F.lit(" "), F.upper("company_name")).alias("company_name"))
    return joins.why_excluded(asked, rejects)


@query("jn_pairs", "affiliations", """
m AS (SELECT DISTINCT company, person FROM affiliations), z AS (SELECT company, count(*) AS members FROM m GROUP BY company)
SELECT company, person, members FROM m JOIN z USING (company) WHERE members > 1""")
def jn_pairs(t):
    return graph.shared_companies(t.affiliations)


@query("jn_triage_drop", "raw_records", f"""
x AS ({S_TRIAGE})
SELECT company_name, rec_seq, 'NONCOMPANY' AS verdict, reason AS why, true AS rule_dropped FROM x
WHERE bucket IN ('reject:own-entity', 'reject:investment')""")
def jn_triage_drop(t):
    return joins.rule_dropped(triaged(t.raw_records))[0]


__all__ = ["S_GATE", "GATE_SHAPES", "S_VARIANTS", "S_NEW", "S_REJECTS", "gated"]

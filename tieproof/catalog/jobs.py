"""Whole-table jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tieproof.catalog.aggregates import S_DECADE, S_DEDUP, S_GAP, dedup_columns, s_upsert
from tieproof.catalog.base import CFG, in_list, lit, query
from tieproof.catalog.base import s_bool3, s_company_role, s_count, s_domain, s_grad_year, s_human, s_missing_founder
from tieproof.catalog.base import s_missing_text, s_name_key, s_netloc, s_non_company, s_norm, s_role, s_school, s_source_score
from tieproof.catalog.base import s_stage, s_status, s_strip, s_text, s_year
from tieproof.catalog.joins import GATE_SHAPES, S_GATE, S_NEW, S_VARIANTS, gated
from tieproof.catalog.rules import s_validate
from tieproof.catalog.scalars import S_FACTS
from tieproof.functions import typing
from tieproof.operators import graph, merge, stats
from tieproof.plans import discover, extract, gate, migrate, repair, store
from tieproof.session import written

C = F.col

_MISSING = in_list(("",) + tuple(typing.MISSING_NUMBER))
_PEOPLE_TEXT = "CASE WHEN founder = '' OR lower(founder) IN ('none', 'unknown', 'n/a') THEN founders ELSE founder END"
S_MIGRATE = f"""
m0 AS (SELECT *, {_PEOPLE_TEXT} AS people, trim(concat(evidence, ' | ', description, ' | type=', affiliation_type), ' |') AS evidence_all,
   CASE WHEN proof_url <> '' THEN proof_url WHEN source_url <> '' THEN source_url ELSE {lit(CFG.fallback_proof_url)} END AS source
   FROM legacy_records),
m1 AS (SELECT *, trim(people) <> '' AND lower(trim(people)) NOT IN ('none', 'unknown', 'n/a') AS named FROM m0),
m2 AS (SELECT *, CASE WHEN named THEN list_filter(list_transform(regexp_split_to_array(people, ',|;| and | & '), lambda x: trim(x)),
     lambda x: length(x) >= 2 AND lower(x) NOT IN ('none', 'unknown', 'n/a'))
   WHEN trim(evidence) <> '' THEN ['(unspecified)'] ELSE [] END AS names,
   CASE WHEN lower(trim(exit_year)) IN {_MISSING} THEN '' ELSE exit_year END AS exit_raw FROM m1),
m3 AS (SELECT *, {s_count('employees_text')} AS heads, {s_year('exit_raw', 1700)} AS exit_y, {s_bool3('is_public')} AS public FROM m2),
mig AS (SELECT *, CASE WHEN trim(company_name) = '' THEN 'no company_name' WHEN len(names) = 0 THEN 'no parseable people'
   WHEN heads IS NULL AND lower(trim(employees_text)) NOT IN {_MISSING}
     THEN concat('validation: Value error, cannot parse int: ''', employees_text, '''')
   WHEN exit_raw <> '' AND exit_y IS NULL THEN concat('validation: Value error, cannot parse year: ''', exit_raw, '''') END AS reason FROM m3),
aff0 AS (SELECT *, unnest(names) AS person, generate_subscripts(names, 1) - 1 AS pos,
   CASE WHEN named THEN evidence_all ELSE evidence END AS basis FROM mig),
aff AS (SELECT rec_seq, company_name, CAST(pos AS INTEGER) AS pos, person, {s_school('basis')} AS school,
   CASE WHEN named THEN {s_role("concat(evidence_all, ' ', affiliation_type)")} ELSE {s_role('basis')} END AS role,
   {s_grad_year('basis')} AS grad_year, CASE WHEN named THEN {s_company_role('basis')} ELSE 'founder' END AS role_at_company,
   CASE WHEN basis <> '' THEN basis ELSE concat(person, ' (migrated)') END AS evidence_span,
   source AS source_url, reason FROM aff0),
migrated AS (SELECT lower(trim(company_name)) AS key, rec_seq, company_name, CAST(len(names) AS INTEGER) AS n_people, source AS proof_url,
   CASE WHEN description <> '' THEN description END AS description, industry, funding_total_usd, {s_stage('funding_stage')} AS funding_stage,
   founded_year, heads AS employee_count, public AS is_public, headquarters, {s_status('status_text', 'public')} AS status,
   exit_y AS exit_year, acquirer, acquisition_amount_usd, validation_tier FROM mig WHERE reason IS NULL
   QUALIFY row_number() OVER (PARTITION BY lower(trim(company_name)) ORDER BY rec_seq DESC) = 1)"""
MIGRATED = (
    "key", "rec_seq", "company_name", "n_people", "proof_url", "description", "industry", "funding_total_usd",
    "funding_stage", "founded_year", "employee_count", "is_public", "headquarters", "status", "exit_year",
    "acquirer", "acquisition_amount_usd", "validation_tier",
)


@query("job_migrate", "legacy_records", S_MIGRATE + f"SELECT {', '.join(MIGRATED)} FROM migrated")
def job_migrate(t):
    return migrate.migrated(t.legacy_records, CFG).withColumn("founded_year", C("founded_year").cast("long")).select(*MIGRATED)


@query("job_migrate_people", "legacy_records", S_MIGRATE + "SELECT * EXCLUDE (reason) FROM aff")
def job_migrate_people(t):
    return migrate.affiliations(t.legacy_records, CFG)


@query("job_migrate_failures", "legacy_records", S_MIGRATE + "SELECT rec_seq, company_name, reason FROM mig WHERE reason IS NOT NULL")
def job_migrate_failures(t):
    return migrate.migrate(t.legacy_records, CFG).where("reason IS NOT NULL").select("rec_seq", "company_name", "reason")


@query("ag_reasons", "legacy_records", S_MIGRATE + """
SELECT 'failure' AS what, reason AS value, count(*) AS n FROM mig WHERE reason IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'tier', validation_tier, count(*) FROM mig WHERE reason IS NULL GROUP BY ALL
UNION ALL SELECT 'school', school, count(*) FROM aff WHERE reason IS NULL GROUP BY ALL
UNION ALL SELECT 'role', role, count(*) FROM aff WHERE reason IS NULL GROUP BY ALL""")
def ag_reasons(t):
    return migrate.reasons(t.legacy_records, CFG)


S_MIG_DEDUP = S_MIGRATE + "," + S_DEDUP.replace("FROM raw_records", "FROM migrated")


@query("job_dedup", "legacy_records", S_MIG_DEDUP + "SELECT * FROM merged")
def job_dedup(t):
    df = migrate.migrated(t.legacy_records, CFG).withColumn("founded_year", C("founded_year").cast("long"))
    return dedup_columns(merge.dedup_merge(df))


@query("job_dedup_issues", "raw_records", S_DEDUP + """,
base AS (SELECT canonical, min(o) AS o FROM g WHERE canonical <> '' GROUP BY canonical HAVING count(*) > 1)
SELECT DISTINCT g.canonical, concat('deduped-with:', company_name) AS issue FROM g JOIN base ON base.canonical = g.canonical
WHERE g.o <> base.o""")
def job_dedup_issues(t):
    return merge.dedup_issues(t.raw_records)


@query("job_dedup_people", "legacy_records", S_MIGRATE + "," + S_DEDUP.replace("FROM raw_records", "FROM legacy_records") + """
SELECT canonical, person, pos, school, role FROM (SELECT g.canonical, g.o, aff.* FROM aff JOIN g ON g.rec_seq = aff.rec_seq)
QUALIFY row_number() OVER (PARTITION BY canonical, person ORDER BY o, pos) = 1""")
def job_dedup_people(t):
    people = migrate.affiliations(t.legacy_records, CFG).select("rec_seq", "pos", "person", "school", "role")
    return merge.dedup_people(t.legacy_records, people).select("canonical", "person", "pos", "school", "role")


_ADMIT = f"""{s_name_key('company_name')} <> '' AND ({s_non_company('company_name')}) IS NULL
  AND (trim(founder) <> '' OR lower(trim(affiliation_type)) = 'licensed tech')"""
S_STORE = f"""
adm AS (SELECT *, {s_name_key('company_name')} AS name_key, rec_seq AS real_seq FROM legacy_records WHERE {_ADMIT}),
ord AS (SELECT * REPLACE ((CASE WHEN verified THEN 0 ELSE 1000000000000 END) + rec_seq AS rec_seq,
  CAST(funding_total_usd AS DOUBLE) AS funding_total_usd, {s_year('founded_year', 1800)} AS founded_year,
  {s_year('exit_year', 1800)} AS exit_year, {s_bool3('is_public')} AS is_public) FROM adm),"""
S_UPSERT = S_STORE + s_upsert("ord") + "," + s_validate("store", "n_sources")
UPSERT_OUT = ("name_key", "company_name", "founder", "industry", "status", "headquarters", "source_url", "verified")


@query("job_upsert", "legacy_records", S_UPSERT + f"""
SELECT {', '.join(UPSERT_OUT)}, n_sources, tier, issue_text, funding_value, founded_value FROM validated""")
def job_upsert(t):
    first = t.legacy_records.where("verified")
    base, sources, _ = store.upsert(None, None, first, CFG)
    merged, _, _ = store.upsert(base.drop("validation_tier", "validation_issues"), sources,
                                t.legacy_records.where("NOT verified"), CFG)
    return merged.select(
        *UPSERT_OUT, "n_sources", C("validation_tier").alias("tier"),
        F.array_join("validation_issues", "; ").alias("issue_text"),
        C("funding_total_usd").alias("funding_value"), C("founded_year").alias("founded_value"),
    )


@query("job_extract_gate", "page_replies", f"""
x AS (SELECT doc_id, page_url, source_text, regexp_extract(reply, '(Firm \\d+, Inc\\.)', 1) AS company_name,
  regexp_extract(reply, '"(P\\d+)"', 1) AS person, regexp_extract(reply, '"P\\d+","(?:evidence_)?span":"([^"]*)"', 1) AS span FROM page_replies),
y AS (SELECT *, {s_name_key('company_name')} AS name_key FROM x
  WHERE trim(span) <> '' AND contains({s_norm('source_text')}, {s_norm('span')}))
SELECT name_key, doc_id, company_name, person, 1 AS n_people, page_url AS source_url, {s_source_score('page_url')} AS source_credibility,
  {s_netloc('page_url')} AS source_domain FROM y QUALIFY row_number() OVER (PARTITION BY page_url, name_key ORDER BY doc_id) = 1""")
def job_extract_gate(t):
    return extract.extract_gate(t.page_replies, CFG).drop("people")


_SECOND = ("industry", "headquarters", "founded_year", "website_url")


def _s_second(f: str) -> str:
    v = f"coalesce(json_extract_string(reply, '$.{f}'), '')"
    sp = f"coalesce(json_extract_string(reply, '$.{f}_evidence_span'), '')"
    proven = f"({sp} = '' OR ({s_strip(sp)} <> '' AND contains({s_norm('source_text')}, {s_norm(sp)})))"
    return f"CASE WHEN {v} <> '' AND {proven} THEN {v} ELSE old_{f} END AS {f}"


@query("job_second_pass", "second_replies", f"""
x AS (SELECT s.*, d.lang AS old_industry, d.source AS old_headquarters, CAST(NULL AS VARCHAR) AS old_founded_year, '' AS old_website_url
  FROM second_replies s JOIN documents d ON d.doc_id = s.doc_id)
SELECT doc_id, {', '.join(_s_second(f) for f in _SECOND)} FROM x""")
def job_second_pass(t):
    records = t.documents.select(
        "doc_id", C("lang").alias("industry"), C("source").alias("headquarters"),
        F.lit(None).cast("string").alias("founded_year"), F.lit("").alias("website_url"))
    return extract.second_pass(records, t.second_replies)


_FN, _FU = s_strip(s_text("found_founders")), s_strip(s_text("found_url"))
S_FILL = f"""
f0 AS (SELECT l.*, f.found_founders, f.found_url, f.page_url, f.page_text,
   {s_missing_founder('founder', 'affiliation_type')} AND lower({_FN}) NOT IN ('', 'unknown', 'n/a') AS tn,
   {s_missing_text('proof_url')} AND lower({_FU}) NOT IN ('', 'unknown', 'n/a') AND starts_with({_FU}, 'http') AS tu,
   {_FN} <> '' OR {_FU} <> '' AS said FROM legacy_records l LEFT JOIN found_facts f ON f.rec_seq = l.rec_seq),
f1 AS (SELECT * REPLACE (
   CASE WHEN tn AND length(trim(evidence)) < 15 THEN concat('Found via targeted gap-fill search: ', trim(page_text)) ELSE evidence END AS evidence,
   CASE WHEN tn THEN trim(string_split({_FN}, ',')[1]) ELSE founder END AS founder,
   CASE WHEN tn THEN {_FN} ELSE founders END AS founders,
   CASE WHEN tu THEN {_FU} ELSE proof_url END AS proof_url),
   tn OR tu AS updated,
   CAST(source_url <> '' AS BIGINT) + CAST(coalesce(said AND page_url <> source_url, false) AS BIGINT) AS n_sources FROM f0),
f2 AS (SELECT * REPLACE (verified OR (said AND n_sources >= 2) AS verified) FROM f1),"""


@query("job_fill_apply", "legacy_records found_facts", S_FILL + s_validate("f2", "n_sources") + """
SELECT rec_seq, founder, founders, proof_url, evidence, verified, updated, tier, issue_text FROM validated""")
def job_fill_apply(t):
    out = repair.fill_apply(t.legacy_records, t.found_facts, CFG)
    return out.select("rec_seq", "founder", "founders", "proof_url", "evidence", "verified", "updated",
                      C("validation_tier").alias("tier"), F.array_join("validation_issues", "; ").alias("issue_text"))


_FIRST = f"trim(string_split({s_strip('founders')}, ',')[1])"
S_REPAIR = f"""
r0 AS (SELECT *, NOT {s_human('founder')} AND {s_strip('founders')} <> '' AND {s_human(_FIRST)} AS promoted FROM legacy_records),
r1 AS (SELECT * REPLACE (
   CASE WHEN promoted AND length(trim(evidence)) < 15
        THEN concat('Recovered from a prior gap-fill result: founders=''', trim(founders), '''') ELSE evidence END AS evidence,
   CASE WHEN promoted THEN {_FIRST} ELSE founder END AS founder) FROM r0),"""


@query("job_repair_founder", "legacy_records", S_REPAIR + s_validate("r1") + """
SELECT rec_seq, promoted, founder, evidence, tier, issue_text FROM validated""")
def job_repair_founder(t):
    return repair.repair_founder(t.legacy_records, CFG).select(
        "rec_seq", "promoted", "founder", "evidence", C("validation_tier").alias("tier"),
        F.array_join("validation_issues", "; ").alias("issue_text"))


@query("job_backlog", "legacy_records", s_validate("legacy_records") + "," + S_GAP + """
SELECT 'tier_changes' AS metric, count(*) FILTER (tier <> validation_tier) AS value FROM validated
UNION ALL SELECT 'weak_with_proof', count(*) FILTER (tier = 'weak' AND proof_url <> '') FROM validated
UNION ALL (UNPIVOT counts ON COLUMNS(*) INTO NAME metric VALUE value)""")
def job_backlog(t):
    return repair.backlog(t.legacy_records, CFG)


@query("job_gate", GATE_SHAPES, S_GATE + """
SELECT rec_seq, company_name, founder, verdict, state, reason, confidence, confidence_provenance, entity_verified, entity_note, source_domain
FROM gated""")
def job_gate(t):
    return gated(t).select(
        "rec_seq", "company_name", "founder", "verdict", "state", "reason", "confidence", "confidence_provenance",
        "entity_verified", "entity_note", "source_domain")


@query("ag_state_counts", GATE_SHAPES, S_GATE + "SELECT state, count(*) AS n FROM gated GROUP BY state")
def ag_state_counts(t):
    return gated(t).groupBy("state").agg(F.count("*").alias("n"))


@query("job_apply_verdicts", "raw_records verdict_log", f"""
SELECT r.rec_seq, r.company_name, r.founder, coalesce(v.verdict, 'UNADJUDICATED') AS verdict,
  CASE WHEN v.verdict = 'FOUNDER' THEN 'kept' ELSE 'rejected' END AS action, {s_domain('proof_url')} AS source_domain,
  evidence FROM raw_records r LEFT JOIN verdict_log v ON v.company_name = r.company_name""")
def job_apply_verdicts(t):
    return gate.apply_verdicts(t.raw_records, t.verdict_log)


@query("job_ecosystem", "raw_records legacy_records affiliations", "d AS (" + S_DECADE + """),
m AS (SELECT DISTINCT company, person FROM affiliations),
w AS (SELECT a.person AS source, b.person AS target, count(*) AS n FROM m a JOIN m b ON a.company = b.company AND a.person < b.person
  GROUP BY ALL),
tf AS (SELECT company_name, funding_total_usd AS n FROM raw_records WHERE funding_total_usd <> 0 ORDER BY 2 DESC, 1 DESC LIMIT 20),
ta AS (SELECT company_name, acquisition_amount_usd AS n FROM legacy_records WHERE acquisition_amount_usd <> 0 ORDER BY 2 DESC, 1 DESC LIMIT 10),
tp AS (SELECT concat(source, ' + ', target) AS pair, n FROM w ORDER BY n DESC, source, target LIMIT 15),
multi AS (SELECT person FROM affiliations GROUP BY person HAVING count(*) > 1)
SELECT 'tier' AS section, validation_tier AS key, count(*) AS n FROM raw_records GROUP BY ALL
UNION ALL SELECT 'status', status, count(*) FROM raw_records GROUP BY ALL
UNION ALL SELECT 'industry', industry, count(*) FROM raw_records GROUP BY ALL
UNION ALL SELECT 'headquarters', headquarters, count(*) FROM raw_records GROUP BY ALL
UNION ALL SELECT 'school', school, count(*) FROM affiliations GROUP BY ALL
UNION ALL SELECT 'role', role, count(*) FROM affiliations GROUP BY ALL
UNION ALL SELECT 'decade', CAST(decade AS VARCHAR), n FROM d
UNION ALL SELECT 'total', 'records', count(*) FROM raw_records
UNION ALL SELECT 'total', 'funded', count(*) FILTER (funding_total_usd <> 0) FROM raw_records
UNION ALL SELECT 'total', 'funding', CAST(sum(funding_total_usd) AS BIGINT) FROM raw_records
UNION ALL SELECT 'total', 'people_in_several', count(*) FROM multi
UNION ALL SELECT 'stage', funding_stage, count(*) FROM legacy_records WHERE funding_stage <> '' GROUP BY ALL
UNION ALL SELECT 'top_funded', company_name, n FROM tf UNION ALL SELECT 'top_acquired', company_name, n FROM ta
UNION ALL SELECT 'top_pair', pair, n FROM tp""")
def job_ecosystem(t):
    # each input is read once: what the report needs of it is written, in few columns, and counted by grouping sets
    r = written(t.raw_records.select("company_name", "validation_tier", "status", "industry", "headquarters", "funding_total_usd", "founded_year"))
    legacy = written(t.legacy_records.select("company_name", "funding_stage", "acquisition_amount_usd"))
    a = written(t.affiliations.select("company", "person", "school", "role"))

    def counted(df, **fields):
        """Counts of every value of each field and of all rows, and the funding of all, in one aggregation."""
        named = df.select(*[c.cast("string").alias(n) for n, c in fields.items()], C("funding_total_usd") if df is r else F.lit(0).alias("funding_total_usd"))
        sets = [[C(n)] for n in fields] + [[]]
        out = named.groupingSets(sets, *[C(n) for n in fields]).agg(
            F.count("*").alias("n"), F.count_if(C("funding_total_usd") != 0).alias("funded"), F.sum("funding_total_usd").alias("funding"),
            F.grouping_id(*[C(n) for n in fields]).alias("_id"))
        width = len(fields)
        section, key = F.lit(None).cast("string"), F.lit(None).cast("string")
        for i, n in enumerate(fields):
            mine = C("_id") == (1 << width) - 1 - (1 << (width - 1 - i))
            section, key = F.when(mine, n).otherwise(section), F.when(mine, C(n)).otherwise(key)
        total = F.array(*[F.struct(F.lit("total").alias("section"), F.lit(k).alias("key"), C(c).cast("long").alias("n"))
                          for k, c in (("records", "n"), ("funded", "funded"), ("funding", "funding"))])
        one = F.array(F.struct(section.alias("section"), key.alias("key"), C("n").cast("long").alias("n")))
        rows = out.select(F.explode(F.when(C("_id") == (1 << width) - 1, total).otherwise(one)).alias("_t")).select("_t.*")
        return rows if df is r else rows.where("section <> 'total'")

    year = C("founded_year")
    decade = F.when(year.between(1900, 2030), (F.floor(year / 10) * 10).cast("int"))
    sections = counted(r, tier=C("validation_tier"), status=C("status"), industry=C("industry"), headquarters=C("headquarters"), decade=decade)
    sections = sections.where("section <> 'decade' OR key IS NOT NULL").union(counted(a, school=C("school"), role=C("role")))
    several = graph.repeat_counts(a).agg(F.count("*").alias("n")).select(
        F.lit("total").alias("section"), F.lit("people_in_several").alias("key"), "n")
    stages = stats.distribution(legacy.where("funding_stage <> ''").withColumnRenamed("funding_stage", "stage"), "stage")

    def top(df, section, key, n, most):
        rows = df.select(F.lit(section).alias("section"), key.alias("key"), C(n).cast("long").alias("n")).where("n <> 0")
        return rows.orderBy(F.desc("n"), F.desc("key")).limit(most)

    pairs = graph.top_pairs(a, 15).select(
        F.lit("top_pair").alias("section"), F.concat("source", F.lit(" + "), "target").alias("key"), C("weight").alias("n"))
    return (
        sections.union(several).union(stages)
        .union(top(r, "top_funded", C("company_name"), "funding_total_usd", 20))
        .union(top(legacy, "top_acquired", C("company_name"), "acquisition_amount_usd", 10)).union(pairs)
    )


def edge_order():
    return F.struct("company", "pos", "role")


@query("job_graph", "affiliations", """
SELECT concat('P:', person) AS id, person AS label, 'person' AS type, school, role FROM affiliations
QUALIFY row_number() OVER (PARTITION BY person ORDER BY company, pos, role) = 1""")
def job_graph(t):
    return graph.people(t.affiliations, edge_order())


@query("job_graph_companies", "raw_records", """
SELECT concat('C:', trim(company_name)) AS id, company_name AS label, 'company' AS type, validation_tier AS tier, status, founded_year,
  funding_total_usd, industry, headquarters, proof_url AS url FROM raw_records
QUALIFY row_number() OVER (PARTITION BY trim(company_name) ORDER BY rec_seq DESC) = 1""")
def job_graph_companies(t):
    return graph.companies(t.raw_records)


@query("job_graph_edges", "affiliations", """
v AS (SELECT person, school FROM affiliations QUALIFY row_number() OVER (PARTITION BY person ORDER BY company, pos, role) = 1)
SELECT concat('P:', a.person) AS source, concat('C:', company) AS target, 'founded_or_role' AS type, a.person AS person_name,
  company AS company_name, v.school FROM affiliations a JOIN v ON v.person = a.person""")
def job_graph_edges(t):
    return graph.person_company(t.affiliations, edge_order())


@query("job_discover", "titles raw_records articles", S_NEW + f""",
s AS (SELECT title, bool_or(contains(lower(concat(description, ' ', extract)), {lit(CFG.institution_word)})) AS sig FROM articles GROUP BY title)
SELECT n.title, CASE WHEN coalesce(sig, false) THEN 'confirmed' ELSE 'rejected_no_signal' END AS outcome
FROM new_titles n LEFT JOIN s ON s.title = n.title""")
def job_discover(t):
    return discover.discover(t.titles, t.raw_records, t.articles, CFG)


S_ENRICH = S_VARIANTS + "," + S_FACTS


@query("job_enrich", "legacy_records articles", S_ENRICH + """
SELECT r.rec_seq, r.company_name, CASE WHEN r.status IN ('', 'unknown') AND f.status IS NOT NULL THEN f.status ELSE r.status END AS status,
  CASE WHEN (r.founded_year IS NULL OR r.founded_year = 0) AND f.founded_year IS NOT NULL THEN f.founded_year ELSE r.founded_year END AS founded_year,
  CASE WHEN r.headquarters IN ('', 'unknown') AND f.headquarters IS NOT NULL THEN f.headquarters ELSE r.headquarters END AS headquarters,
  CASE WHEN r.acquirer IN ('', 'unknown') AND f.acquirer IS NOT NULL THEN f.acquirer ELSE r.acquirer END AS acquirer,
  CASE WHEN f.is_public THEN true END AS is_public, h.title IS NOT NULL AS enriched,
  CASE WHEN h.title IS NOT NULL THEN 'wikipedia-enriched' ELSE '' END AS issues,
  CASE WHEN h.title IS NOT NULL THEN concat('https://en.wikipedia.org/wiki/', url_encode(h.title)) END AS wikipedia_url
FROM legacy_records r LEFT JOIN hit h ON h.company_name = r.company_name LEFT JOIN facts f ON f.article_id = h.article_id""")
def job_enrich(t):
    records = t.legacy_records.withColumn("is_public", F.lit(None).cast("boolean"))
    return discover.enrich(records, t.articles).select(
        "rec_seq", "company_name", "status", "founded_year", "headquarters", "acquirer", "is_public", "enriched",
        F.array_join("validation_issues", "; ").alias("issues"), "wikipedia_url")


@query("jn_enrich", "legacy_records articles", S_ENRICH + """
SELECT r.rec_seq, h.article_id, f.status AS article_status, f.founded_year AS article_year FROM legacy_records r
JOIN hit h ON h.company_name = r.company_name LEFT JOIN facts f ON f.article_id = h.article_id""")
def jn_enrich(t):
    from tieproof.operators.enrich import article_facts, find_articles

    f = article_facts(C("extract"))
    found = find_articles(t.legacy_records, t.articles).select(
        "company_name", "article_id", f["status"].alias("article_status"), f["founded_year"].alias("article_year"))
    return t.legacy_records.select("rec_seq", "company_name").join(found, "company_name").drop("company_name")


@query("ag_enrich_rate", "raw_records articles", S_ENRICH + """
SELECT count(*) AS queried, count(h.article_id) AS hits, count(*) - count(h.article_id) AS misses,
  round(count(h.article_id) / count(*), 3) AS hit_rate, count(f.status) AS status_found,
  count(f.headquarters) AS headquarters_found, count(f.founded_year) AS founded_year_found
FROM n LEFT JOIN hit h ON h.company_name = n.company_name LEFT JOIN facts f ON f.article_id = h.article_id""")
def ag_enrich_rate(t):
    return discover.enrichment_summary(t.raw_records, t.articles)



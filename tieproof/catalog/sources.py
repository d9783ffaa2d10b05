"""Readers and writers, on content derived from the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieproof.catalog.aggregates import S_OVERLAY, overlaid
from tieproof.catalog.base import CFG, query, s_bool3, s_name_key, s_text
from tieproof.catalog.jobs import S_MIGRATE
from tieproof.catalog.joins import GATE_SHAPES, S_GATE, gated
from tieproof.operators import graph
from tieproof.plans.migrate import migrate
from tieproof.session import scratch, written
from tieproof.sources import readers, writers

C = F.col
_SCHEMA = "rec_seq:bigint,company_name:string,founder:string,status:string"


@query("src_records", "raw_records", f"""
k AS (SELECT {s_name_key('company_name')} AS name_key, rec_seq, company_name, founder, status FROM raw_records)
SELECT * FROM k WHERE name_key <> '' QUALIFY row_number() OVER (PARTITION BY name_key ORDER BY rec_seq DESC) = 1""")
def src_records(t):
    # Documents of five thousand records in the three layouts, in turn; each is a file written by one task, a record a line.
    doc = F.floor(C("rec_seq") / 5000)
    row = F.to_json(F.struct("rec_seq", "company_name", "founder", "status"))
    rows = t.raw_records.select(doc.alias("doc"), "rec_seq", F.concat(
        F.when(doc % 3 == 2, F.concat(F.lit('"'), "company_name", F.lit('":'))).otherwise(""), row).alias("line"))
    first = rows.groupBy("doc").agg(F.min("rec_seq").alias("first"))
    rows = rows.join(first, "doc").select("doc", "rec_seq", F.concat(F.when(C("rec_seq") > C("first"), ",").otherwise(""), "line").alias("value"))
    opens = F.when(C("doc") % 3 == 0, "[").when(C("doc") % 3 == 1, '{"records":[').otherwise("{")
    closes = F.when(C("doc") % 3 == 0, "]").when(C("doc") % 3 == 1, '],"count":{"of":"}"}}').otherwise("}")
    edges = first.select("doc", F.explode(F.array(
        F.struct(F.lit(-1).cast("long").alias("rec_seq"), opens.alias("value")),
        F.struct(F.lit(1 << 62).alias("rec_seq"), closes.alias("value")))).alias("_e")).select("doc", "_e.*")
    path = scratch(t.spark)
    lines = rows.unionByName(edges).withColumn("doc", F.lpad(C("doc").cast("string"), 12, "0"))
    lines.repartition("doc").sortWithinPartitions("doc", "rec_seq").select("doc", "value").write.partitionBy("doc").text(path)
    return readers.read_records(t.spark, f"{path}/*", _SCHEMA)


@query("src_verdict_log", "verdicts", """
SELECT concat('Firm ', CAST(floor(doc_id / 3) AS BIGINT)) AS company_name, arg_max(verdict, doc_id) AS verdict FROM verdicts GROUP BY 1""")
def src_verdict_log(t):
    name = F.concat(F.lit("Firm "), F.floor(C("doc_id") / 3).cast("string"))
    line = F.to_json(F.struct(name.alias("company_name"), "verdict"))
    lines = t.verdicts.select(C("doc_id").alias("seq"), line.alias("line"))
    blank = t.verdicts.select((C("doc_id") + 0.5).cast("long").alias("seq"), F.lit("  ").alias("line"))
    return readers.last_verdicts(lines.union(blank))


@query("src_page_cache", "visits", """
SELECT DISTINCT url, CAST(date_trunc('second', ts) AS TIMESTAMP) AS captured_at, concat('Body of', chr(10), url) AS text FROM visits""")
def src_page_cache(t):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    content = F.concat(
        F.lit("URL: "), "url", F.lit("\nCAPTURED: "), stamp, F.lit("\n\nBody of\n"), "url")
    good = t.visits.select(content.alias("value"))
    bad = t.visits.select(F.concat(F.lit("no header "), "url").alias("value"))
    path = scratch(t.spark)
    good.union(bad).write.option("lineSep", "\x1e").text(path)
    return readers.read_page_cache(t.spark, path, "\x1e").distinct()


@query("src_overlay", "raw_records", S_OVERLAY + "SELECT * FROM o")
def src_overlay(t):
    return overlaid(t)


@query("src_graph_reply", "affiliations", "SELECT DISTINCT company, person AS founder FROM affiliations")
def src_graph_reply(t):
    value = lambda c: F.struct(C(c).alias("value"))
    binding = F.struct(value("company").alias("companyLabel"), value("person").alias("founderLabel"))
    reply = F.to_json(F.struct(F.struct(F.array(binding, binding).alias("bindings")).alias("results")))
    return readers.parse_bindings(t.affiliations.select(reply.alias("reply")))


@query("src_category_reply", "titles", "SELECT DISTINCT title FROM titles")
def src_category_reply(t):
    member = F.array(F.struct("title"))
    reply = F.to_json(F.struct(F.struct(member.alias("categorymembers")).alias("query")))
    return readers.parse_members(t.titles.select(reply.alias("reply")))


@query("src_snapshot", "procs", "SELECT pid, ppid, name FROM procs")
def src_snapshot(t):
    good = t.procs.select(F.concat_ws("\t", C("pid").cast("string"), C("ppid").cast("string"), "name").alias("line"))
    bad = t.procs.select(F.concat(F.lit("x"), C("pid").cast("string"), F.lit("\t1\tname")).alias("line"))
    short = t.procs.select(F.concat(C("pid").cast("string"), F.lit("\tname")).alias("line"))
    return readers.parse_snapshot(good.union(bad).union(short))


@query("snk_json", "raw_records", "SELECT rec_seq, company_name, status FROM raw_records")
def snk_json(t):
    path = scratch(t.spark)
    writers.write_json(t.raw_records.select("rec_seq", "company_name", "status"), path)
    return t.spark.read.schema("rec_seq long, company_name string, status string").json(path)


@query("snk_store", "raw_records", "SELECT rec_seq, company_name, validation_tier FROM raw_records")
def snk_store(t):
    path = scratch(t.spark)
    df = t.raw_records.select("rec_seq", "company_name", "validation_tier")
    writers.publish(df.where("validation_tier = 'high'"), path)
    writers.publish(df, path)
    return writers.current(t.spark, path)


def _s_full(field: str, have: set[str]) -> str:
    if field == "is_public":
        return f"CASE WHEN {s_bool3(field)} THEN 'Yes' WHEN NOT {s_bool3(field)} THEN 'No' ELSE 'Unknown' END"
    if field == "verified":
        return "CASE WHEN verified THEN 'Yes' ELSE 'No' END"
    return s_text(field) if field in have else "''"


_LEGACY = {
    "company_name", "founder", "founders", "description", "proof_url", "affiliation_type", "evidence", "industry",
    "status", "founded_year", "funding_total_usd", "funding_stage", "employee_count", "headquarters", "exit_year",
    "acquirer", "source_url", "source_credibility", "validation_tier",
}
_FULL = ", ".join(f'{_s_full(f, _LEGACY)} AS "{n}"' for n, f in writers.FULL_COLUMNS.items())


@query("snk_csv_full", "legacy_records", f"SELECT {_FULL} FROM legacy_records ORDER BY lower(company_name), rec_seq")
def snk_csv_full(t):
    path = scratch(t.spark)
    writers.write_full_csv(t.legacy_records, path)
    return t.spark.read.csv(path, header=True, schema=", ".join(f"`{n}` string" for n in writers.FULL_COLUMNS), escape='"').na.fill("")


def _company_records(t):
    return t.orders.select(
        F.concat(F.lit("C"), C("o_orderkey").cast("string")).alias("company_name"),
        C("o_orderstatus").alias("status"), C("o_orderpriority").alias("validation_tier"),
        F.floor("o_totalprice").cast("long").alias("funding_total_usd"),
    )


_COMPANIES = """co AS (SELECT concat('C', o_orderkey) AS company, o_orderstatus AS status, o_orderpriority AS validation_tier,
  CAST(floor(o_totalprice) AS BIGINT) AS funding_total_usd FROM orders)"""


@query("snk_csv_company", "affiliations", _COMPANIES + """,
a AS (SELECT company, count(*) AS member_count, array_to_string(list_sort(list_distinct(list(school))), '; ') AS schools
  FROM affiliations GROUP BY company)
SELECT co.company, status, validation_tier, funding_total_usd, CAST(NULL AS VARCHAR) AS acquirer, coalesce(member_count, 0) AS member_count,
  coalesce(schools, '') AS schools, p.pos, p.person AS name
FROM co LEFT JOIN a ON a.company = co.company LEFT JOIN affiliations p ON p.company = co.company""")
def snk_csv_company(t):
    return writers.companies_flat(_company_records(t), t.affiliations).select(
        "company", "status", "validation_tier", "funding_total_usd", "acquirer", "member_count", "schools", "pos", "name")


@query("snk_csv_edges", "affiliations", _COMPANIES + """
SELECT a.person, a.company, a.role, a.school, a.pos, concat(a.role, ' of ', repeat(a.school, 40)) AS evidence_span,
  validation_tier AS company_tier, status AS company_status, funding_total_usd AS company_funding_usd
FROM affiliations a LEFT JOIN co ON co.company = a.company""")
def snk_csv_edges(t):
    people = t.affiliations.withColumn("evidence_span", F.concat("role", F.lit(" of "), F.repeat("school", 40)))
    return writers.edges_long(_company_records(t), people)


@query("snk_graph", "affiliations raw_records", """
c AS (SELECT company_name, arg_max(validation_tier, rec_seq) AS tier, arg_max(status, rec_seq) AS status FROM raw_records GROUP BY 1),
m AS (SELECT DISTINCT company, person FROM affiliations), z AS (SELECT company, count(*) AS members FROM m GROUP BY company)
SELECT 'nodes_people' AS name, concat('P:', person) AS row FROM (SELECT DISTINCT person FROM affiliations)
UNION ALL SELECT 'nodes_companies', concat('C:', company_name, '|', tier, '|', status) FROM c
UNION ALL SELECT 'edges_person_company', concat('P:', person, '|C:', company) FROM affiliations
UNION ALL SELECT 'edges_person_person', concat('P:', a.person, '|P:', b.person, '|', count(*), '|', string_agg(a.company, '; ' ORDER BY a.company))
  FROM m a JOIN m b ON a.company = b.company AND a.person < b.person GROUP BY a.person, b.person HAVING count(*) > 1
UNION ALL SELECT 'edges_shared_company', concat(company, '|', person, '|', members) FROM m JOIN z USING (company) WHERE members > 1""")
def snk_graph(t):
    path = scratch(t.spark)
    order = F.struct("company", "pos", "role")
    shown = {
        "nodes_people": ["id"], "nodes_companies": ["id", "tier", "status"], "edges_person_company": ["source", "target"],
        "edges_shared_company": ["company", "person", "members"], "edges_person_person": ["source", "target", "weight", "label"],
    }
    people, shared = written(graph.people(t.affiliations, order)), written(graph.shared_companies(t.affiliations))
    names = writers.write_graph({
        "nodes_people": people,
        "nodes_companies": graph.companies(t.raw_records),
        "edges_person_company": graph.person_company(t.affiliations, order, people),
        "edges_shared_company": shared,
        "edges_person_person": graph.person_person(t.affiliations, shared),
        "nothing": t.affiliations.where("person IS NULL"),
    }, path)
    back = [
        t.spark.read.csv(f"{path}/{n}", header=True).select(F.lit(n).alias("name"), F.concat_ws("|", *shown[n]).alias("row"))
        for n in names
    ]
    return reduce(DataFrame.unionByName, back)


@query("snk_by_state", GATE_SHAPES, S_GATE + "SELECT rec_seq, confidence, state FROM gated")
def snk_by_state(t):
    path = scratch(t.spark)
    writers.write_by_state(gated(t).select("rec_seq", "confidence", "state"), path)
    return t.spark.read.parquet(path).select("rec_seq", "confidence", "state")


@query("snk_by_failure", "legacy_records", S_MIGRATE + """
SELECT company_name, reason, replace(string_split(reason, ':')[1], ' ', '_') AS status FROM mig WHERE reason IS NOT NULL""")
def snk_by_failure(t):
    path = scratch(t.spark)
    failed = migrate(t.legacy_records, CFG).where("reason IS NOT NULL").select(
        "company_name", "reason", F.regexp_replace(F.split("reason", ":")[0], " ", "_").alias("status"))
    writers.write_failures(failed, path)
    return t.spark.read.json(path).select("company_name", "reason", "status")


@query("snk_page_cache", "visits", """
SELECT substr(sha256(url), 1, 16) AS url_key, url, max(ts) AS captured_at, arg_max(concat('round ', round), ts) AS text
FROM visits GROUP BY url""")
def snk_page_cache(t):
    return writers.cache_pages(t.visits.select(
        "url", C("ts").alias("captured_at"), F.concat(F.lit("round "), C("round").cast("string")).alias("text")))



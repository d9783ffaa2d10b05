"""Cleaning and typing columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tieproof.catalog.base import CFG, query
from tieproof.catalog.base import s_bool3, s_canonical, s_company_role, s_count, s_domain, s_get, s_grad_year, s_human
from tieproof.catalog.base import s_is_url, s_last_name, s_money_typed, s_name_key, s_norm, s_role, s_school
from tieproof.catalog.base import s_source_score, s_stage, s_status, s_strip, s_whole, s_year
from tieproof.functions import names, typing, urls
from tieproof.functions.text import normalize_text, short_hash
from tieproof.operators.enrich import article_facts, migration_evidence

C = F.col


@query("fn_name_key", "raw_records", f"""
SELECT rec_seq, company_name, {s_name_key('company_name')} AS name_key FROM raw_records""")
def fn_name_key(t):
    return t.raw_records.select("rec_seq", "company_name", names.name_key(C("company_name")).alias("name_key"))


@query("fn_canonical_name", "raw_records", f"""
SELECT rec_seq, company_name, {s_canonical('company_name')} AS canonical FROM raw_records""")
def fn_canonical_name(t):
    return t.raw_records.select("rec_seq", "company_name", names.canonical_name(C("company_name")).alias("canonical"))


@query("fn_canonical_short", "raw_records", f"""
SELECT rec_seq, company_name, {s_canonical('company_name', names.FORM_WORDS_SHORT)} AS canonical FROM raw_records""")
def fn_canonical_short(t):
    return t.raw_records.select(
        "rec_seq", "company_name", names.canonical_name_short(C("company_name")).alias("canonical")
    )


_TRACK = "(" + ", ".join(f"'{p}'" for p in urls.TRACKING) + ")"


@query("fn_url_canonical", "", f"""
u AS (SELECT page_id, url, lower(regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.\\-]*):', 1)) AS scheme,
        lower({s_get('url', urls.NETLOC)}) AS host,
        regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\\-]*:(?://[^/?#]*)?([^?#]*)', 1) AS path,
        array_to_string(list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'),
          lambda p: p <> '' AND lower(string_split(p, '=')[1]) NOT IN {_TRACK}), '&') AS q,
        regexp_extract(url, '^[^#]*#(.*)$', 1) AS frag FROM pages)
SELECT page_id, concat(scheme, '://', host, CASE WHEN path = '/' AND q = '' AND frag = '' THEN '' ELSE path END,
  CASE WHEN q = '' THEN '' ELSE concat('?', q) END, CASE WHEN frag = '' THEN '' ELSE concat('#', frag) END) AS canonical
FROM u""")
def fn_url_canonical(t):
    return t.pages.select("page_id", urls.canonicalize_url(C("url")).alias("canonical"))


@query("fn_domain", "", f"SELECT page_id, {s_domain('url')} AS domain FROM pages")
def fn_domain(t):
    return t.pages.select("page_id", urls.domain(C("url")).alias("domain"))


@query("fn_url_wellformed", "raw_records", f"""
SELECT kind, n, url, ok FROM (
  SELECT 'page' AS kind, page_id AS n, url, {s_is_url('url')} AS ok FROM pages
  UNION ALL SELECT 'proof', rec_seq, proof_url, {s_is_url('proof_url')} FROM raw_records
  UNION ALL SELECT 'text', rec_seq, funding_text, {s_is_url('funding_text')} FROM raw_records)""")
def fn_url_wellformed(t):
    def part(df, kind, key, col):
        return df.select(
            F.lit(kind).alias("kind"), C(key).alias("n"), C(col).alias("url"), urls.is_url(C(col)).alias("ok")
        )

    r = t.raw_records
    return part(t.pages, "page", "page_id", "url").union(part(r, "proof", "rec_seq", "proof_url")).union(
        part(r, "text", "rec_seq", "funding_text")
    )


@query("fn_money_typed", "raw_records", f"""
SELECT rec_seq, funding_text, {s_money_typed('funding_text')} AS value,
  CASE WHEN {s_money_typed('funding_text')} IS NULL AND funding_text <> ''
       THEN concat('cannot parse money: ''', funding_text, '''') END AS error
FROM raw_records""")
def fn_money_typed(t):
    m = typing.money_typed(C("funding_text"))
    return t.raw_records.select("rec_seq", "funding_text", m["value"].alias("value"), m["error"].alias("error"))


def s_money_lenient(x: str, what: str) -> str:
    """Value and issue in SQL, by peeling the text in the same steps."""
    s0 = f"trim(replace(replace(replace(lower(trim({x})), '$', ''), ',', ''), 'usd', ''))"
    s1 = f"trim(regexp_replace(regexp_replace({s0}, '[+~]+', '', 'g'), '\\b(?:approx|around|over|under|about|circa)\\b', '', 'g'))"
    units = [("k", "thousand", "1e3"), ("m", "million", "1e6"), ("b", "billion", "1e9"), ("t", "trillion", "1e12")]
    cut = "CASE " + " ".join(
        f"WHEN ends_with({s1}, '{a}') OR ends_with({s1}, ' {w}') THEN "
        f"trim(replace(regexp_replace({s1}, '{a}+$', ''), ' {w}', ''))" for a, w, _ in units
    ) + f" ELSE {s1} END"
    mult = "CASE " + " ".join(
        f"WHEN ends_with({s1}, '{a}') OR ends_with({s1}, ' {w}') THEN {m}" for a, w, m in units
    ) + " ELSE 1.0 END"
    num = f"CASE WHEN regexp_matches({cut}, '{typing.NUMBER}') THEN TRY_CAST({cut} AS DOUBLE) * CAST({mult} AS DOUBLE) END"
    gone = f"({x} IS NULL OR {x} IN ('', 'Unknown', 'unknown', 'N/A', 'n/a') OR {s0} = '')"
    if what == "value":
        return f"CASE WHEN {gone} THEN NULL WHEN {num} BETWEEN 0 AND 5e12 THEN {num} END"
    return f"""CASE WHEN {gone} THEN NULL WHEN {num} IS NULL THEN concat('could not parse funding_total_usd: ''', {x}, '''')
      WHEN {num} < 0 OR {num} > 5e12
        THEN concat('funding_total_usd out of plausible range: ', CAST({num} AS VARCHAR)) END"""


@query("fn_money_lenient", "raw_records loose_values", f"""
SELECT 'r' AS src, rec_seq AS n, funding_text AS raw, {s_money_lenient('funding_text', 'value')} AS value,
  {s_money_lenient('funding_text', 'issue')} AS issue FROM raw_records
UNION ALL SELECT 'p', p_partkey, money_text, {s_money_lenient('money_text', 'value')},
  {s_money_lenient('money_text', 'issue')} FROM loose_values""")
def fn_money_lenient(t):
    def part(df, src, key, col):
        m = typing.money_lenient(C(col))
        return df.select(F.lit(src).alias("src"), C(key).alias("n"), C(col).alias("raw"),
                         m["value"].alias("value"), m["issue"].alias("issue"))

    return part(t.raw_records, "r", "rec_seq", "funding_text").union(part(t.loose_values, "p", "p_partkey", "money_text"))


@query("fn_year", "loose_values", f"""
SELECT p_partkey, year_text, {s_year('year_text', 1800)} AS lenient, {s_year('year_text', 1700)} AS typed,
  CASE WHEN year_text IN ('', 'Unknown', 'unknown', 'N/A', 'n/a') OR {s_whole('year_text')} BETWEEN 1800 AND 2030 THEN NULL
       WHEN {s_whole('year_text')} IS NULL THEN concat('unparseable year: ''', year_text, '''')
       ELSE concat('year out of plausible range (1800-2030): ', {s_whole('year_text')}) END AS issue,
  CASE WHEN year_text = '' OR {s_whole('year_text')} BETWEEN 1700 AND 2030 THEN NULL
       WHEN {s_whole('year_text')} IS NULL THEN concat('cannot parse year: ''', year_text, '''')
       ELSE concat('year ', {s_whole('year_text')}, ' out of plausible range') END AS error
FROM loose_values""")
def fn_year(t):
    a, b = typing.year_lenient(C("year_text")), typing.year_typed(C("year_text"))
    return t.loose_values.select(
        "p_partkey", "year_text", a["value"].alias("lenient"), b["value"].alias("typed"),
        a["issue"].alias("issue"), b["error"].alias("error"),
    )


@query("fn_count_range", "loose_values", f"""
SELECT p_partkey, count_text, {s_count('count_text')} AS value,
  CASE WHEN count_text = 'few' THEN 'cannot parse int: ''few''' END AS error FROM loose_values""")
def fn_count_range(t):
    m = typing.count_range(C("count_text"))
    return t.loose_values.select("p_partkey", "count_text", m["value"].alias("value"), m["error"].alias("error"))


@query("fn_bool3", "loose_values", f"SELECT p_partkey, bool_text, {s_bool3('bool_text')} AS flag FROM loose_values")
def fn_bool3(t):
    return t.loose_values.select("p_partkey", "bool_text", typing.bool3(C("bool_text")).alias("flag"))


@query("fn_pubstr", "loose_values", f"""
SELECT p_partkey, bool_text, CASE WHEN {s_bool3('bool_text')} THEN 'Yes' WHEN NOT {s_bool3('bool_text')} THEN 'No'
  ELSE 'Unknown' END AS shown FROM loose_values""")
def fn_pubstr(t):
    return t.loose_values.select(
        "p_partkey", "bool_text", typing.yes_no_unknown(typing.bool3(C("bool_text"))).alias("shown")
    )


@query("fn_stage", "loose_values", f"SELECT p_partkey, stage_text, {s_stage('stage_text')} AS stage FROM loose_values")
def fn_stage(t):
    return t.loose_values.select("p_partkey", "stage_text", typing.funding_stage(C("stage_text")).alias("stage"))


@query("fn_status", "legacy_records", f"""
SELECT rec_seq, status_text, {s_status('status_text', s_bool3('is_public'))} AS status FROM legacy_records""")
def fn_status(t):
    return t.legacy_records.select(
        "rec_seq", "status_text", typing.status(C("status_text"), typing.bool3(C("is_public"))).alias("status")
    )


_INFER = "concat(evidence, ' ', founder, ' ', affiliation_type, CASE WHEN rec_seq % 5 = 1 THEN ' Postdoc, board' ELSE '' END)"


def _infer_text(df):
    extra = F.when(C("rec_seq") % 5 == 1, F.lit(" Postdoc, board")).otherwise("")
    return df.withColumn(
        "txt", F.concat(C("evidence"), F.lit(" "), C("founder"), F.lit(" "), C("affiliation_type"), extra)
    )


@query("fn_school", "legacy_records", f"SELECT rec_seq, {s_school(_INFER)} AS school FROM legacy_records")
def fn_school(t):
    return _infer_text(t.legacy_records).select(
        "rec_seq", typing.school(C("txt"), CFG.school_patterns, CFG.school_default).alias("school")
    )


@query("fn_role", "legacy_records", f"SELECT rec_seq, {s_role(_INFER)} AS role FROM legacy_records")
def fn_role(t):
    return _infer_text(t.legacy_records).select("rec_seq", typing.person_role(C("txt")).alias("role"))


@query("fn_company_role", "legacy_records", f"SELECT rec_seq, {s_company_role(_INFER)} AS role FROM legacy_records")
def fn_company_role(t):
    return _infer_text(t.legacy_records).select("rec_seq", typing.company_role(C("txt")).alias("role"))


@query("fn_grad_year", "raw_records", f"SELECT rec_seq, {s_grad_year('evidence')} AS grad_year FROM raw_records")
def fn_grad_year(t):
    return t.raw_records.select("rec_seq", typing.grad_year(C("evidence")).alias("grad_year"))


@query("fn_tags", "loose_values", f"""
SELECT p_partkey, array_to_string(list_filter(list_transform(regexp_split_to_array(tag_text, '[,;/]'),
  lambda x: {s_strip('x')}), lambda x: x <> ''), '|') AS tags FROM loose_values""")
def fn_tags(t):
    return t.loose_values.select("p_partkey", F.array_join(names.to_tags(C("tag_text")), "|").alias("tags"))


@query("fn_split_people", "raw_records", f"""
SELECT rec_seq, n AS person FROM (SELECT rec_seq, unnest(list_transform(
  regexp_split_to_array(founder, ',|;| and | & '), lambda x: {s_strip('x')})) AS n FROM raw_records)
WHERE length(n) >= 2 AND lower(n) NOT IN ('none', 'unknown', 'n/a')""")
def fn_split_people(t):
    return t.raw_records.select("rec_seq", F.explode(names.split_people(C("founder"))).alias("person"))


@query("fn_human_name", "raw_records", f"""
SELECT rec_seq, founder, {s_human('founder')} AS human, {s_human('headquarters')} AS place_is_human FROM raw_records""")
def fn_human_name(t):
    return t.raw_records.select(
        "rec_seq", "founder", names.is_human_name(C("founder")).alias("human"),
        names.is_human_name(C("headquarters")).alias("place_is_human"),
    )


@query("fn_last_name", "raw_records", f"SELECT rec_seq, {s_last_name('founder')} AS last_name FROM raw_records")
def fn_last_name(t):
    return t.raw_records.select("rec_seq", names.last_name(C("founder")).alias("last_name"))


@query("fn_text_norm", "claims", f"SELECT doc_id, {s_norm('span')} AS norm FROM claims")
def fn_text_norm(t):
    return t.claims.select("doc_id", normalize_text(C("span")).alias("norm"))


@query("fn_prompt_hash", "", "SELECT doc_id, substr(sha256(text), 1, 8) AS prompt_hash FROM documents")
def fn_prompt_hash(t):
    return t.documents.select("doc_id", short_hash(C("text")).alias("prompt_hash"))


@query("fn_http_class", "fetch_log", """
SELECT event_id, http_status, CASE WHEN http_status = 200 THEN 'ok' WHEN http_status = 429 THEN 'long_backoff'
  WHEN http_status BETWEEN 500 AND 599 THEN 'retryable' WHEN http_status BETWEEN 400 AND 499 THEN 'fatal'
  ELSE 'retryable' END AS http_class FROM fetch_log""")
def fn_http_class(t):
    return t.fetch_log.select("event_id", "http_status", typing.http_class(C("http_status")).alias("http_class"))


@query("fn_source_score", "", f"SELECT page_id, {s_source_score('url')} AS score FROM pages")
def fn_source_score(t):
    return t.pages.select(
        "page_id", urls.source_score(C("url"), CFG.source_tiers, CFG.default_source_tier).alias("score")
    )


S_FACTS = """
f AS (SELECT article_id, extract,
   TRY_CAST(regexp_extract(extract, '(?i)\\b(?:founded|established|incorporated)\\s+(?:in\\s+)?(\\d{4})', 1) AS INTEGER) AS y,
   trim(regexp_extract(extract, '(?i)\\bacquired\\s+(?:by|in\\s+\\d{4}\\s+by)?\\s+([^.,;]+?)(?:\\s+(?:in|for|on)\\b|\\.|,|;|$)', 1)) AS acq,
   regexp_matches(extract, '(?i)\\b(?:went public|ipo|listed on|initial public offering)\\b') AS ipo,
   regexp_matches(extract, '(?i)\\b(?:shut down|ceased operations|defunct|dissolved|wound down)\\b') AS shut,
   trim(regexp_extract(extract, '(?i)\\b(?:headquartered|based)\\s+in\\s+([^.,;]+?)(?:\\.|,|;|$)', 1)) AS hq
 FROM articles),
facts AS (SELECT article_id, CASE WHEN y BETWEEN 1800 AND 2030 THEN y END AS founded_year,
   CASE WHEN ipo THEN 'ipo' WHEN acq <> '' THEN 'acquired' WHEN shut THEN 'shutdown' END AS status,
   CASE WHEN acq <> '' AND length(acq) < 80 THEN acq END AS acquirer,
   CASE WHEN ipo THEN true END AS is_public,
   CASE WHEN hq <> '' AND length(hq) < 120 THEN hq END AS headquarters FROM f)"""


@query("fn_text_facts", "articles", S_FACTS + "SELECT * FROM facts")
def fn_text_facts(t):
    f = article_facts(C("extract"))
    return t.articles.select("article_id", *[f[k].alias(k) for k in (
        "founded_year", "status", "acquirer", "is_public", "headquarters")])


@query("fn_migrate_evidence", "legacy_records", """
SELECT rec_seq, trim(concat(evidence, ' | ', description, ' | type=', affiliation_type), ' |') AS evidence
FROM legacy_records""")
def fn_migrate_evidence(t):
    e = migration_evidence(C("evidence"), C("description"), C("affiliation_type"))
    return t.legacy_records.select("rec_seq", e.alias("evidence"))

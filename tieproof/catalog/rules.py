"""Filters, predicates and rule classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tieproof.catalog.base import CFG, lit, query
from tieproof.catalog.base import in_list, s_blocklisted, s_bool3, s_count, s_entity, s_get, s_has, s_human, s_is_url
from tieproof.catalog.base import s_money_typed, s_non_company, s_status, s_strip, s_text, s_triage_bucket, s_year
from tieproof.catalog.scalars import s_money_lenient
from tieproof.functions import pages as pg
from tieproof.functions import rules
from tieproof.functions.typing import STAGES
from tieproof.operators.records import (
    ambiguous_records, check_schema, health_candidates, heuristic_verify, list_records, typed_fields,
)

C = F.col


@query("flt_blocklist", "raw_records", f"SELECT rec_seq, company_name FROM raw_records WHERE {s_blocklisted('company_name')}")
def flt_blocklist(t):
    return t.raw_records.where(rules.blocklisted(C("company_name"), CFG)).select("rec_seq", "company_name")


@query("flt_non_company", "raw_records", f"""
SELECT rec_seq, company_name, {s_non_company('company_name')} AS reason FROM raw_records
UNION ALL SELECT rec_seq, concat('Angel ', company_name), {s_non_company("concat('Angel ', company_name)")} FROM raw_records""")
def flt_non_company(t):
    r = t.raw_records.select("rec_seq", "company_name")
    angels = r.withColumn("company_name", F.concat(F.lit("Angel "), C("company_name")))
    return r.union(angels).withColumn("reason", rules.non_company_reason(C("company_name"), CFG))


@query("flt_entity_rules", "raw_records", f"""
SELECT rec_seq, company_name, {s_entity('company_name')} AS entity_type FROM raw_records""")
def flt_entity_rules(t):
    return t.raw_records.select("rec_seq", "company_name", rules.entity_type(C("company_name"), CFG).alias("entity_type"))


S_TRIAGE = f"""SELECT rec_seq, company_name, {s_triage_bucket('company_name', 'founder', 'evidence')} AS bucket,
  CASE {s_triage_bucket('company_name', 'founder', 'evidence')}
    WHEN 'reject:own-entity' THEN concat('name starts with the institution: ''', company_name, '''')
    WHEN 'reject:investment' THEN concat('name matches investment/foundation term ''',
       {s_get('company_name', rules.INVESTMENT_WORDS, 0, '(?i)')}, '''')
    WHEN 'reject:employment' THEN 'evidence shows employment/exec/donor role, no founding language'
    WHEN 'keep:founding-language' THEN 'evidence contains a founding assertion'
    ELSE 'no explicit founding language in evidence' END AS reason FROM raw_records"""


def triaged(df):
    t = rules.triage(C("company_name"), C("founder"), C("evidence"), CFG)
    return df.withColumn("bucket", t["bucket"]).withColumn("reason", t["reason"])


@query("cls_triage", "raw_records", S_TRIAGE)
def cls_triage(t):
    return triaged(t.raw_records).select("rec_seq", "company_name", "bucket", "reason")


def s_validate(src: str, sources: str = "0") -> str:
    """SELECT of the records with their issue list, tier and coerced fields."""
    name, founder = s_strip(s_text("company_name")), s_strip(s_text("founder"))
    proof, ev = s_strip(s_text("proof_url")), s_strip(s_text("evidence"))
    low = f"lower({name})"
    generic = " OR ".join(
        f"{low} = {lit(t)} OR starts_with({low}, {lit(t + ' ')}) OR ends_with({low}, {lit(' ' + t)})"
        for t in rules.GENERIC_TOKENS
    )
    licensed = f"lower({s_strip(s_text('affiliation_type'))}) = 'licensed tech'"
    canonical = "(" + " OR ".join(f"contains(lower({proof}), {lit(s)})" for s in rules.CANONICAL_SOURCES) + ")"
    odd = f"list_filter(list_transform(string_split({s_strip(s_text('founders'))}, ','), lambda x: trim(x)), lambda x: x <> '' AND NOT {s_human('x')})"

    def year_issue(f: str) -> str:
        whole = f"CASE WHEN regexp_matches(trim({s_text(f)}), '^[+-]?[0-9]+$') THEN CAST(trim({s_text(f)}) AS BIGINT) END"
        return f"""CASE WHEN {s_text(f)} IN ('', 'Unknown', 'unknown', 'N/A', 'n/a') OR {whole} BETWEEN 1800 AND 2030 THEN NULL
          WHEN {whole} IS NULL THEN concat('{f}: unparseable year: ''', {f}, '''')
          ELSE concat('{f}: year out of plausible range (1800-2030): ', {whole}) END"""

    return f"""
v1 AS (SELECT *, list_filter([
  CASE WHEN {name} = '' THEN 'missing company_name' END,
  CASE WHEN {name} <> '' AND {s_blocklisted('company_name')}
       THEN 'name matches non-startup blocklist (fund/program/placeholder)' END,
  CASE WHEN {name} <> '' AND NOT {s_blocklisted('company_name')} AND ({generic})
       THEN concat('company_name looks generic/placeholder: ''', {name}, '''') END,
  CASE WHEN {name} <> '' AND NOT {s_blocklisted('company_name')} AND (starts_with({name}, '[') OR ends_with({name}, ']'))
       THEN concat('company_name looks like a placeholder: ''', {name}, '''') END,
  CASE WHEN {founder} = '' AND NOT ({licensed}) THEN 'missing founder (required unless Licensed Tech)' END,
  CASE WHEN {founder} <> '' AND NOT {s_human('founder')}
       THEN concat('founder doesn''t look like a full human name: ''', {founder}, '''') END,
  CASE WHEN {proof} = '' THEN 'missing proof_url' END,
  CASE WHEN {proof} <> '' AND NOT {s_is_url('proof_url')} THEN concat('proof_url malformed: ''', {proof}, '''') END,
  CASE WHEN {ev} = '' THEN 'missing affiliation_evidence' END,
  CASE WHEN {ev} <> '' AND length({ev}) < 15 THEN concat('affiliation_evidence too short: ''', {ev}, '''') END,
  CASE WHEN {s_money_lenient('CAST(funding_total_usd AS VARCHAR)', 'issue')} IS NOT NULL
       THEN concat('funding_total_usd: ', {s_money_lenient('CAST(funding_total_usd AS VARCHAR)', 'issue')}) END,
  {year_issue('founded_year')}, {year_issue('exit_year')},
  CASE WHEN {s_strip(s_text('founders'))} <> '' AND lower({s_strip(s_text('founders'))}) NOT IN ('unknown', 'n/a')
            AND len({odd}) > 0
       THEN concat('founders contain non-name tokens: [', array_to_string(list_transform({odd}, lambda x: concat('''', x, '''')), ', '), ']') END,
  CASE WHEN source_credibility <= 2 AND {sources} < 2 AND NOT {canonical}
       THEN concat('single-source from low-credibility origin (source_credibility=', source_credibility,
                   '); cross-reference recommended') END
  ], lambda x: x IS NOT NULL) AS issues, {canonical} AS canonical_source FROM {src}),
validated AS (SELECT * EXCLUDE (issues), array_to_string(issues, '; ') AS issue_text, len(issues) AS n_issues,
  CASE WHEN len(list_filter(issues, lambda i: starts_with(i, 'missing ') OR starts_with(i, 'name matches'))) > 0 THEN 'weak'
       WHEN len(issues) > 0 THEN 'provisional' WHEN canonical_source OR {sources} >= 2 THEN 'high'
       ELSE 'provisional' END AS tier,
  {s_money_lenient('CAST(funding_total_usd AS VARCHAR)', 'value')} AS funding_value,
  {s_year('founded_year', 1800)} AS founded_value, {s_year('exit_year', 1800)} AS exit_value,
  {s_bool3('is_public')} AS public_flag FROM v1)
"""


def validated(df):
    """Validated records with the columns the SQL side names."""
    out = rules.validate(df, CFG)
    return out.withColumns({
        "issue_text": F.array_join("validation_issues", "; "),
        "n_issues": F.size("validation_issues").cast("long"),
    })


@query("cls_validate", "legacy_records", s_validate("legacy_records") + """
SELECT rec_seq, company_name, tier, issue_text, n_issues, funding_value, founded_value, exit_value, public_flag
FROM validated""")
def cls_validate(t):
    return validated(t.legacy_records).select(
        "rec_seq", "company_name", C("validation_tier").alias("tier"), "issue_text", "n_issues",
        C("funding_total_usd").alias("funding_value"), C("founded_year").alias("founded_value"),
        C("exit_year").alias("exit_value"), C("is_public").alias("public_flag"),
    )


@query("cls_enum_check", "legacy_records", f"""
x AS (SELECT rec_seq, company_name, evidence, {s_status('status_text', s_bool3('is_public'))} AS status, funding_text,
  {s_money_typed('funding_text')} AS funding, founded_year, {s_year('exit_year', 1700)} AS exit_y, exit_year,
  employees_text, {s_count('employees_text')} AS employees, lower(funding_stage) AS stage, validation_tier FROM legacy_records),
e AS (SELECT rec_seq, company_name, CASE
   WHEN rec_seq % 7 = 0 THEN 'people must not be empty'
   WHEN rec_seq % 5 = 0 THEN 'school not allowed: ''Elsewhere'''
   WHEN rec_seq % 4 = 2 THEN 'role not allowed: ''guest'''
   WHEN rec_seq % 190 < 10 OR rec_seq % 190 > 180 THEN concat('grad_year out of range: ', 1850 + rec_seq % 190)
   WHEN rec_seq % 3 = 2 THEN 'role_at_company not allowed: ''boss'''
   WHEN {s_strip('evidence')} = '' THEN 'evidence_span must be non-empty'
   WHEN funding_text <> '' AND funding IS NULL THEN concat('cannot parse money: ''', funding_text, '''')
   WHEN stage <> '' AND stage NOT IN {in_list(STAGES)} THEN concat('funding_stage not allowed: ''', stage, '''')
   WHEN exit_year <> '' AND exit_y IS NULL THEN concat('cannot parse year: ''', exit_year, '''')
   WHEN employees_text NOT IN ('', 'n/a') AND employees IS NULL THEN concat('cannot parse int: ''', employees_text, '''')
   END AS error FROM x)
SELECT rec_seq, company_name, error IS NULL AS ok, error FROM e""")
def cls_enum_check(t):
    def pick(n, *values):
        return F.element_at(F.array(*map(F.lit, values)), (C("rec_seq") % n + 1).cast("int"))

    person = F.struct(
        F.lit("Ann Lee").alias("name"), F.when(C("rec_seq") % 5 == 0, "Elsewhere").otherwise("main").alias("school"),
        pick(4, "alumnus", "faculty", "guest", "student").alias("role"), (1850 + C("rec_seq") % 190).alias("grad_year"),
        pick(3, "founder", "ceo", "boss").alias("role_at_company"), C("evidence").alias("evidence_span"))
    people = F.when(C("rec_seq") % 7 == 0, F.slice(F.array(person), 1, 0)).otherwise(F.array(person))
    df = typed_fields(t.legacy_records, CFG).withColumns({"funding_stage": F.lower("funding_stage"), "people": people})
    return check_schema(df, CFG).select("rec_seq", "company_name", "ok", "error")


@query("flt_ambiguous", "raw_records", f"""
SELECT rec_seq, company_name, founder FROM raw_records
WHERE {s_strip('evidence')} = '' AND NOT {s_human('founder')} AND {s_strip('proof_url')} = ''""")
def flt_ambiguous(t):
    return ambiguous_records(t.raw_records).select("rec_seq", "company_name", "founder")


@query("flt_keep_remove", "raw_records", f"""
x AS (SELECT rec_seq, company_name, {s_non_company('company_name')} AS reason FROM raw_records)
SELECT rec_seq, company_name, CASE WHEN reason IS NULL THEN 'keep' ELSE 'remove' END AS action, reason FROM x""")
def flt_keep_remove(t):
    return heuristic_verify(t.raw_records, CFG).select("rec_seq", "company_name", "action", "reason")


@query("flt_weak_with_proof", "legacy_records", s_validate("legacy_records") + """
SELECT company_name, rec_seq, count(*) OVER () AS total FROM validated WHERE tier = 'weak' AND proof_url <> ''""")
def flt_weak_with_proof(t):
    return health_candidates(rules.validate(t.legacy_records, CFG))


@query("flt_company_title", "titles", """
SELECT p_partkey, title FROM titles
WHERE NOT starts_with(title, 'List of') AND NOT starts_with(title, 'Category:') AND NOT contains(title, ' (disambiguation)')""")
def flt_company_title(t):
    return t.titles.where(rules.looks_like_company_title(C("title"))).select("p_partkey", "title")


@query("flt_signal_word", "", f"""
SELECT doc_id, contains(lower(concat(source, ' ', text)), {lit(CFG.institution_word)}) AS signal FROM documents""")
def flt_signal_word(t):
    hay = F.lower(F.concat(C("source"), F.lit(" "), C("text")))
    return t.documents.select("doc_id", F.contains(hay, F.lit(CFG.institution_word)).alias("signal"))


def _s_field(pattern: str, name: str, flags: str = "(?i)") -> str:
    return f"nullif(trim({s_get('html', pattern, 1, flags)}), '') AS {name}"


@query("flt_page_wall", "profile_pages", f"""
SELECT page_id, {s_has('html', pg.AUTH_WALL)} AS auth_wall, {s_has('html', pg.CAPTCHA)} AS captcha,
  contains(url, '/login') OR contains(url, 'authwall') AS login_redirect,
  {', '.join(_s_field(p, f) for f, p in pg.PAGE_FIELDS.items())},
  {', '.join(_s_field(p, 'profile_' + f) for f, p in pg.PROFILE_FIELDS.items())}, {_s_field(pg.PROFILE_TYPE, 'profile_type', '')}
FROM profile_pages""")
def flt_page_wall(t):
    signals = pg.page_signals(C("html"), C("url"))
    signals.update({"profile_" + n: c for n, c in pg.profile_fields(C("html")).items()})
    return t.profile_pages.select("page_id", *[c.alias(n) for n, c in signals.items()])


_DENY = " AND ".join(f"NOT contains({s_get('u', '^[a-zA-Z][a-zA-Z0-9+.\\-]*://([^/?#]*)')}, {lit(d)})" for d in pg.LINK_DENY)


@query("flt_links", "link_pages", f"""
x AS (SELECT page_id, list_filter(regexp_extract_all(html, '<a\\b[^>]*\\bhref="(http[^"]*)"', 1), lambda u: {_DENY}) AS l FROM link_pages),
y AS (SELECT page_id, unnest(l) AS link, generate_subscripts(l, 1) AS i FROM x),
z AS (SELECT page_id, link, min(i) AS i FROM y GROUP BY ALL)
SELECT page_id, link, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos FROM z""")
def flt_links(t):
    return t.link_pages.select("page_id", F.posexplode(pg.outbound_links(C("html"))).alias("pos", "link")).withColumn(
        "pos", C("pos").cast("long")
    )


@query("flt_list_filtered", "raw_records", """
SELECT rec_seq, company_name, founded_year FROM raw_records WHERE validation_tier = 'high' AND founded_year >= 1980
ORDER BY company_name, rec_seq LIMIT 50""")
def flt_list_filtered(t):
    return list_records(t.raw_records, tier="high", founded_after=1980, limit=50).select(
        "rec_seq", "company_name", "founded_year"
    )


__all__ = ["triaged", "validated", "s_validate", "S_TRIAGE"]

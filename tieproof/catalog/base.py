"""Registry, and the SQL spelling of expressions that several checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tieproof.config import DEFAULT as CFG
from tieproof.functions import names as fn_names
from tieproof.functions import rules as fn_rules
from tieproof.functions import text as fn_text
from tieproof.functions import typing as fn_typing
from tieproof.functions import urls as fn_urls
from tieproof.sources.shapes import Tables, with_shapes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, shapes: str = "", sql: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name``; ``sql`` is its check."""

    def register(fn):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = with_shapes(shapes, sql)
        return fn

    return register


# --- SQL expressions ---------------------------------------------------------

WS, NOT_WORD_OR_WS = fn_text.WS, fn_text.NOT_WORD_OR_WS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def s_text(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), '')"


def s_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def s_squeeze(x: str) -> str:
    return s_strip(f"regexp_replace({x}, '{WS}+', ' ', 'g')")


def s_norm(x: str) -> str:
    return s_squeeze(f"lower({s_text(x)})")


def s_has(x: str, pattern: str, flags: str = "(?i)") -> str:
    return f"regexp_matches({x}, {lit(flags + pattern)})"


def s_get(x: str, pattern: str, group: int = 1, flags: str = "") -> str:
    return f"regexp_extract({x}, {lit(flags + pattern)}, {group})"


def s_name_key(x: str) -> str:
    n = f"regexp_replace(lower({s_strip(s_text(x))}), {lit(fn_names.TRAILING_FORM)}, '')"
    return s_squeeze(f"regexp_replace({n}, '{NOT_WORD_OR_WS}', '', 'g')")


def s_canonical(x: str, forms: str = fn_names.FORM_WORDS) -> str:
    n = f"regexp_replace(lower({s_text(x)}), {lit(fn_names.PAREN)}, ' ', 'g')"
    n = f"regexp_replace({n}, {lit(forms)}, ' ', 'g')"
    n = s_squeeze(f"regexp_replace({n}, '{NOT_WORD_OR_WS}', ' ', 'g')")
    return f"regexp_replace({n}, '^the ', '')"


def s_human(x: str) -> str:
    n = s_strip(s_text(x))
    return (
        f"({n} <> '' AND lower({n}) NOT IN {in_list(fn_names.NOT_A_PERSON)} AND contains({n}, ' ') "
        f"AND regexp_matches({n}, {lit(fn_names.HUMAN_NAME)}))"
    )


def s_last_name(x: str) -> str:
    return f"lower({s_get(s_text(x), '([^\\s\\x{0B}\\x{1C}-\\x{1F}\\x{85}\\p{Z}]+)' + WS + '*$')})"


def s_quoted(x: str) -> str:
    return f"concat('''', {x}, '''')"


def s_netloc(x: str) -> str:
    return s_get(s_text(x), fn_urls.NETLOC)


def s_domain(x: str) -> str:
    return f"replace(lower({s_netloc(x)}), 'www.', '')"


def s_is_url(x: str) -> str:
    u = s_strip(s_text(x))
    h = s_netloc(u)
    return f"({s_has(u, '^https?:')} AND contains({h}, '.') AND lower({h}) NOT IN {in_list(fn_urls.NOT_A_HOST)})"


def s_case(x: str, rules, default: str, empty: str | None = None) -> str:
    whens = " ".join(f"WHEN {s_has(s_text(x), p)} THEN {lit(label)}" for p, label in rules)
    return f"CASE WHEN {s_text(x)} = '' THEN {lit(default if empty is None else empty)} {whens} ELSE {lit(default)} END"


def s_map(x: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {x} {whens} ELSE {default} END"


def s_blocklisted(x: str) -> str:
    return f"({s_name_key(x)} IN {in_list(sorted({fn_rules.store_key_of(n) for n in CFG.blocklist}))})"


def s_non_company(x: str) -> str:
    signals = " OR ".join(f"contains(lower({s_text(x)}), {lit(s)})" for s in fn_rules.ORG_SIGNALS)
    return f"""CASE WHEN {s_blocklisted(x)} THEN concat('blocklisted: ''', {x}, ''' is a known non-startup / program / fund')
      WHEN starts_with({s_name_key(x)}, 'venture in') THEN concat('placeholder entry: ''', {x}, '''')
      WHEN {signals} THEN concat('looks like org/program/fund, not a startup: ''', {x}, '''') END"""


def s_entity(x: str) -> str:
    n = s_strip(s_text(x))
    return f"""CASE WHEN {s_has(n, fn_rules.own_entity_pattern(CFG))} THEN 'university_unit'
      WHEN {s_has(n, fn_rules.FOUNDATION_NAME)} THEN 'foundation'
      WHEN {s_has(n, fn_rules.FUND_NAME)} THEN 'investment_fund' ELSE 'unknown' END"""


def s_triage_bucket(name: str, founder: str, evidence: str) -> str:
    n = s_strip(s_text(name))
    hay = f"concat({s_text(evidence)}, ' ', {s_text(founder)}, ' ', {n})"
    return f"""CASE WHEN {s_has(n, fn_rules.own_entity_pattern(CFG))} THEN 'reject:own-entity'
      WHEN {s_has(n, fn_rules.INVESTMENT_WORDS)} THEN 'reject:investment'
      WHEN {s_has(s_text(evidence), fn_rules.EMPLOYMENT_WORDS)} AND NOT {s_has(hay, fn_rules.FOUNDING_WORDS)}
        THEN 'reject:employment'
      WHEN {s_has(hay, fn_rules.FOUNDING_WORDS)} THEN 'keep:founding-language'
      ELSE 'review:no-founding' END"""


def s_missing_founder(founder: str, kind: str) -> str:
    f = s_strip(s_text(founder))
    return (
        f"(({f} = '' AND lower({s_strip(s_text(kind))}) <> 'licensed tech') "
        f"OR ({f} <> '' AND NOT {s_human(founder)}))"
    )


def s_missing_text(x: str) -> str:
    return f"(lower({s_strip(s_text(x))}) IN ('', 'unknown', 'n/a'))"


def s_money_typed(x: str) -> str:
    t = s_strip(s_text(x))
    d = f"replace({s_get(t, fn_typing.MONEY, 1)}, ',', '')"
    f = (
        f"CASE upper({s_get(t, fn_typing.MONEY, 2)}) WHEN 'K' THEN 1000 WHEN 'M' THEN 1000000 "
        f"WHEN 'B' THEN 1000000000 ELSE 1 END"
    )
    return f"CASE WHEN {s_text(x)} <> '' AND {d} <> '' THEN CAST(floor(CAST({d} AS DOUBLE) * {f}) AS BIGINT) END"


def s_year(x: str, low: int) -> str:
    y = s_whole(x)
    return f"CASE WHEN {y} BETWEEN {low} AND 2030 THEN CAST({y} AS INTEGER) END"


def s_whole(x: str) -> str:
    t = s_strip(s_text(x))
    return f"CASE WHEN regexp_matches({t}, '{fn_typing.INTEGER}') THEN TRY_CAST({t} AS BIGINT) END"


def s_count(x: str) -> str:
    t = s_strip(s_text(x))
    span = r"^([\d,]+)\s*[-–to]+\s*([\d,]+)\+?$"
    num = lambda e: f"TRY_CAST(replace({e}, ',', '') AS BIGINT)"
    return f"""CASE WHEN {t} = '' OR lower({t}) IN {in_list(fn_typing.MISSING_NUMBER)} THEN NULL
      WHEN regexp_matches({t}, '{span}')
        THEN CAST(floor(({num(s_get(t, span, 1))} + {num(s_get(t, span, 2))}) / 2) AS BIGINT)
      WHEN regexp_matches({t}, '^([\\d,]+)\\+$') THEN {num(s_get(t, '^([\\d,]+)\\+$', 1))}
      ELSE {num(t)} END"""


def s_bool3(x: str) -> str:
    t = f"lower({s_strip(s_text(x))})"
    return f"CASE WHEN {t} IN ('true', 'yes', 'y') THEN true WHEN {t} IN ('false', 'no', 'n') THEN false END"


def s_stage(x: str) -> str:
    t = f"replace(lower({s_strip(s_text(x))}), ' ', '-')"
    return f"CASE WHEN {t} IN {in_list(fn_typing.STAGES)} THEN {t} ELSE {s_map(t, fn_typing.STAGE_VARIANTS, 'NULL')} END"


def s_status(x: str, public: str) -> str:
    t = f"lower({s_strip(s_text(x))})"
    return f"CASE WHEN coalesce({public}, false) THEN 'ipo' ELSE {s_map(t, fn_typing.STATUS_MAP, lit('unknown'))} END"


def s_school(x: str) -> str:
    return s_case(x, tuple(CFG.school_patterns) + (CFG.school_default,), "unknown")


def s_role(x: str) -> str:
    return s_case(x, fn_typing.ROLE_PATTERNS, "alumnus")


def s_company_role(x: str) -> str:
    return s_case(x, fn_typing.COMPANY_ROLE_PATTERNS, "founder")


def s_grad_year(x: str) -> str:
    y = f"TRY_CAST({s_get(s_text(x), fn_typing.GRAD_YEAR, 1)} AS INTEGER)"
    return f"CASE WHEN {y} BETWEEN 1860 AND 2030 THEN {y} END"


def s_source_score(url: str) -> str:
    h = f"lower({s_netloc(url)})"
    whens = " ".join(
        f"WHEN contains({h}, {lit(p)}) THEN {tier}"
        for p, tier in sorted(CFG.source_tiers.items(), key=lambda kv: -len(kv[0]))
    )
    return f"CASE {whens} ELSE {CFG.default_source_tier} END"


def s_tier(url: str) -> str:
    return f"CASE WHEN {s_domain(url)} IN {in_list(CFG.directory_domains)} THEN 'directory' ELSE 'mention' END"


def s_tie(x: str) -> str:
    return f"CASE WHEN {s_strip(s_text(x))} <> '' THEN 'strong' ELSE 'weak' END"


def s_rank(x: str) -> str:
    return f"(CASE {x} WHEN 'high' THEN 3 WHEN 'provisional' THEN 2 ELSE 1 END)"

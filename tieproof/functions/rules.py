"""Rule classifiers: is it a company, what does the evidence say, how good is the record."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tieproof.config import Config
from tieproof.functions.names import is_human_name, name_key
from tieproof.functions.text import ci, is_blank, once, quoted, strip, text
from tieproof.functions.typing import bool3, money_lenient, money_number, year_lenient, year_number
from tieproof.functions.urls import is_url

# Substrings that give away a programme or a fund.
ORG_SIGNALS = (
    "venture fund", "ventures fund", "angel", "capital fund", "incubator",
    "accelerator program", "i-corps", "hackathon", "startup alliance", "design consulting",
)
# Words that make a company name look invented.
GENERIC_TOKENS = (
    "ai-driven", "ai driven", "platform", "solution", "solutions", "technology",
    "technologies", "system", "systems", "lorem", "ipsum", "example",
    "todo", "tbd", "n/a", "unknown", "anonymous", "various", "multiple",
)
# Sources that count as canonical when they occur in the proof url.
CANONICAL_SOURCES = (
    "wikipedia.org", "crunchbase.com", "sec.gov", "pitchbook.com", "linkedin.com/company",
    "techcrunch.com", "bloomberg.com", "reuters.com", "forbes.com",
)
# Name rules of the entity check.
FUND_NAME = (
    r"\b(ventures|venture partners|equity partners|capital partners|capital management|"
    r"capital|private equity|fund|accelerator|incubator|angel|holdings|advisors)\b"
)
FOUNDATION_NAME = r"\b(foundation|endowment|philanthropies|charitable trust)\b"
# Word lists of the triage.
FOUNDING_WORDS = (
    r"\b(founded|co-?founded|co-?founder|founder of|founding (?:member|team|partner)|"
    r"started the company|started the firm|launched the (?:company|startup|firm)|"
    r"co-?created|spun out|spin-?out|incorporated the)\b"
)
EMPLOYMENT_WORDS = (
    r"\b(now (?:at|a|an|applied|senior|principal)|works? at|working at|joined|"
    r"employee|analyst|(?:hr |product |program )?manager|consultant|"
    r"engineer at|scientist at|researcher at|director at|"
    r"chair(?:man|woman|person)?|ceo of|cto|cfo|coo|president of|"
    r"vice president|vp |board member|advisor|intern|associate at|"
    r"partner at|alma mater|donor|gift from|support from|named after|namesake)\b"
)
INVESTMENT_WORDS = (
    r"\b(ventures|venture partners|venture capital|capital partners|capital management|"
    r"\bVC\b|private equity|foundation|\bfund\b|\bfunds\b|accelerator|incubator|"
    r"angel(?:s| group| network)|holdings|advisors|endowment)\b"
)
TRIAGE_ORDER = (
    "keep:founding-language", "review:no-founding", "reject:employment",
    "reject:own-entity", "reject:investment",
)

# Allowed values of the typed schema.
ROLES = ("alumnus", "faculty", "student", "postdoc", "researcher")
GRAD_YEARS = (1860, 2030)
COMPANY_ROLES = ("founder", "cofounder", "ceo", "cto", "early_employee", "board", "investor", "advisor")
STATUSES = ("active", "acquired", "shutdown", "ipo", "unknown")
TIERS = ("high", "provisional", "weak")
TIER_RANK = {"high": 3, "provisional": 2, "weak": 1}


def one_of_texts(words) -> str:
    """Pattern that finds any of the literal words."""
    return "(?:" + "|".join(re.escape(w) for w in words) + ")"


def own_entity_pattern(cfg: Config) -> str:
    return r"^(the\s+)?(" + "|".join(cfg.institution_names) + r")\b"


def store_key_of(name: str) -> str:
    """The store key of one configuration entry."""
    n = re.sub(r"\s*,?\s*(inc\.?|llc\.?|ltd\.?|corp\.?|co\.?|plc\.?)$", "", name.strip().lower())
    return " ".join(re.sub(r"[^\w\s]", "", n).split())


def blocklisted(name: Column, cfg: Config) -> Column:
    return name_key(name).isin(*sorted({store_key_of(n) for n in cfg.blocklist}))


def non_company_reason(name: Column, cfg: Config) -> Column:
    """Why a name cannot be a company; null when nothing speaks against it."""
    n = text(name)
    lower = F.lower(n)
    return (
        F.when(
            blocklisted(name, cfg),
            F.concat(F.lit("blocklisted: '"), n, F.lit("' is a known non-startup / program / fund")),
        )
        .when(
            F.startswith(name_key(name), F.lit("venture in")),
            F.concat(F.lit("placeholder entry: '"), n, F.lit("'")),
        )
        .when(
            lower.rlike(one_of_texts(ORG_SIGNALS)),
            F.concat(F.lit("looks like org/program/fund, not a startup: '"), n, F.lit("'")),
        )
    )


def entity_type(name: Column, cfg: Config) -> Column:
    n = strip(text(name))
    return (
        F.when(n.rlike(ci(own_entity_pattern(cfg))), "university_unit")
        .when(n.rlike(ci(FOUNDATION_NAME)), "foundation")
        .when(n.rlike(ci(FUND_NAME)), "investment_fund")
        .otherwise("unknown")
    )


def triage(name: Column, founder: Column, evidence: Column, cfg: Config) -> Column:
    """struct(bucket, reason); the first rule that applies decides."""
    n = strip(text(name))
    hay = F.concat_ws(" ", text(evidence), text(founder), n)
    founding = hay.rlike(ci(FOUNDING_WORDS))
    employed = text(evidence).rlike(ci(EMPLOYMENT_WORDS))
    own, invest = n.rlike(ci(own_entity_pattern(cfg))), n.rlike(ci(INVESTMENT_WORDS))
    bucket = (
        F.when(own, "reject:own-entity")
        .when(invest, "reject:investment")
        .when(employed & ~founding, "reject:employment")
        .when(founding, "keep:founding-language")
        .otherwise("review:no-founding")
    )
    reason = (
        F.when(own, F.concat(F.lit("name starts with the institution: "), quoted(n)))
        .when(
            invest,
            F.concat(
                F.lit("name matches investment/foundation term "),
                quoted(F.regexp_extract(n, ci(INVESTMENT_WORDS), 0)),
            ),
        )
        .when(employed & ~founding, "evidence shows employment/exec/donor role, no founding language")
        .when(founding, "evidence contains a founding assertion")
        .otherwise("no explicit founding language in evidence")
    )
    return F.struct(bucket.alias("bucket"), reason.alias("reason"))


AMOUNT_FIELDS = ("funding_total_usd", "last_round_amount_usd", "valuation_usd", "exit_value_usd")
YEAR_FIELDS = ("founded_year", "funding_last_round_year", "exit_year", "grad_year")


NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _typed(df) -> dict[str, Column]:
    """struct(value, issue) of every amount and year field the table has."""
    kinds = dict(df.dtypes)
    amounts = {f: (money_number if kinds[f] in NUMERIC else money_lenient)(F.col(f)) for f in AMOUNT_FIELDS if f in kinds}
    years = {f: (year_number if kinds[f] in NUMERIC else year_lenient)(F.col(f)) for f in YEAR_FIELDS if f in kinds}
    return {**amounts, **years}


def coerce(df):
    """Amounts as doubles, years as ints, ``is_public`` as a three-valued flag; bad values become null."""
    values = {f: s["value"] for f, s in _typed(df).items()}
    if "is_public" in df.columns:
        values["is_public"] = bool3(F.col("is_public").cast("string"))
    return df.withColumns(values) if values else df


def validate(df, cfg: Config):
    """Coerce the typed fields of a record and set ``validation_tier`` / ``validation_issues``.

    Fields a table does not have are read as missing. The cleaned inputs are
    columns of their own, so that each is worked out once per row.
    """
    have = set(df.columns)

    def col(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")

    cleaned = {"name": "company_name", "founder": "founder", "proof": "proof_url", "evidence": "evidence", "people": "founders"}
    base = df.withColumns({
        **{"_" + k: strip(text(col(f))) for k, f in cleaned.items()},
        "_licensed": F.lower(strip(text(col("affiliation_type")))) == "licensed tech",
        "_blocked": blocklisted(col("company_name"), cfg),
        "_canonical": F.lower(text(col("proof_url"))).rlike(one_of_texts(CANONICAL_SOURCES)),
    })
    name, founder, proof, evidence, people = (F.col("_" + k) for k in cleaned)
    named, canonical = (name != "") & ~F.col("_blocked"), F.col("_canonical")
    token = one_of_texts(GENERIC_TOKENS)
    generic = F.lower(name).rlike(f"^{token}$|^{token} | {token}$")
    tokens = F.filter(F.transform(F.split(people, ","), strip), lambda x: x != "")
    odd = F.filter(tokens, lambda x: ~is_human_name(x))
    sources = F.lit(0)
    if "n_sources" in have:
        sources = F.col("n_sources")
    elif "all_sources" in have:
        sources = F.size(F.coalesce(F.col("all_sources"), F.array().cast("array<string>")))
    multi, credibility = sources >= 2, col("source_credibility").cast("int")

    def note(cond: Column, *message) -> Column:
        parts = [m if isinstance(m, Column) else F.lit(m) for m in message]
        return F.when(cond, F.concat(*parts) if len(parts) > 1 else parts[0])

    issues = F.filter(
        F.array(
            note(name == "", "missing company_name"),
            note((name != "") & F.col("_blocked"), "name matches non-startup blocklist (fund/program/placeholder)"),
            note(named & generic, "company_name looks generic/placeholder: ", quoted(name)),
            note(named & name.rlike(r"^\[|\]$"), "company_name looks like a placeholder: ", quoted(name)),
            note((founder == "") & ~F.col("_licensed"), "missing founder (required unless Licensed Tech)"),
            note((founder != "") & ~is_human_name(founder), "founder doesn't look like a full human name: ", quoted(founder)),
            note(proof == "", "missing proof_url"),
            note((proof != "") & ~is_url(proof), "proof_url malformed: ", quoted(proof)),
            note(evidence == "", "missing affiliation_evidence"),
            note((evidence != "") & (F.length(evidence) < 15), "affiliation_evidence too short: ", quoted(evidence)),
            *[note(s["issue"].isNotNull(), f + ": ", s["issue"]) for f, s in _typed(df).items()],
            note(
                (people != "") & ~F.lower(people).isin("unknown", "n/a") & (F.size(odd) > 0),
                "founders contain non-name tokens: [", F.array_join(F.transform(odd, quoted), ", "), "]",
            ),
            note(
                (credibility <= 2) & ~multi & ~canonical,
                "single-source from low-credibility origin (source_credibility=", credibility.cast("string"),
                "); cross-reference recommended",
            ),
        ),
        lambda x: x.isNotNull(),
    )

    out = base.withColumn("validation_issues", once(issues))
    found = F.col("validation_issues")
    required = F.exists(found, lambda i: i.rlike("^missing |^name matches"))
    out = out.withColumn(
        "validation_tier",
        F.when(required, "weak").when(F.size(found) > 0, "provisional")
        .when(canonical | multi, "high").otherwise("provisional"),
    )
    # The list reads the fields as they came, so they are coerced last.
    return coerce(out.drop("_licensed", "_blocked", "_canonical", *["_" + k for k in cleaned]))


def ambiguous(founder: Column, evidence: Column, proof: Column) -> Column:
    """Nothing at all speaks for the record."""
    return is_blank(evidence) & ~is_human_name(founder) & is_blank(proof)


def missing_founder(founder: Column, affiliation_type: Column) -> Column:
    f = strip(text(founder))
    licensed = F.lower(strip(text(affiliation_type))) == "licensed tech"
    return ((f == "") & ~licensed) | ((f != "") & ~is_human_name(f))


def missing_text(c: Column) -> Column:
    return F.lower(strip(text(c))).isin("", "unknown", "n/a")


def tier_rank(c: Column) -> Column:
    return F.when(c == "high", 3).when(c == "provisional", 2).otherwise(1)


def looks_like_company_title(title: Column) -> Column:
    return ~(
        F.startswith(title, F.lit("List of"))
        | F.startswith(title, F.lit("Category:"))
        | F.contains(title, F.lit(" (disambiguation)"))
    )

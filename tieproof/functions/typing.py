"""Typed values out of loose text, each with the issue text that explains a null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tieproof.functions.text import first_match, let, mapped, quoted, strip, text

# Spellings of "missing" and limits of each field.
MISSING_WORDS = ("", "Unknown", "unknown", "N/A", "n/a")
MISSING_NUMBER = ("unknown", "n/a", "na", "none", "null", "-")
FUNDING_MAX = 5_000_000_000_000.0
MONEY = r"\$?\s*([\d,]+(?:\.\d+)?)\s*([MmBbKk]?)"
NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"
INTEGER = r"^[+-]?\d{1,18}$"

# Status and stage vocabularies.
STATUS_MAP = {
    "active": "active", "alive": "active", "operating": "active",
    "acquired": "acquired", "acquisition": "acquired",
    "shut down": "shutdown", "shutdown": "shutdown", "closed": "shutdown", "defunct": "shutdown",
    "ipo": "ipo", "public": "ipo", "listed": "ipo",
}
STAGES = (
    "pre-seed", "seed", "series-a", "series-b", "series-c", "series-d", "series-e",
    "growth", "public", "unknown",
)
STAGE_VARIANTS = {
    "a": "series-a", "series_a": "series-a", "b": "series-b", "series_b": "series-b",
    "c": "series-c", "series_c": "series-c", "preseed": "pre-seed",
}

# Role vocabularies, tried in this order.
ROLE_PATTERNS = (
    (r"\b(faculty|professor|associate\s+professor|assistant\s+professor)\b", "faculty"),
    (r"\b(post.?doc|postdoctoral)\b", "postdoc"),
    (r"\b(phd\s+student|graduate\s+student|undergraduate|current\s+student|enrolled)\b", "student"),
    (r"\b(researcher|research\s+scientist|lab\s+member)\b", "researcher"),
)
COMPANY_ROLE_PATTERNS = (
    (r"\b(co.?founder|cofounder)\b", "cofounder"),
    (r"\b(founder)\b", "founder"),
    (r"\bceo\b", "ceo"),
    (r"\bcto\b", "cto"),
    (r"\bboard\b", "board"),
    (r"\b(advisor|advisory)\b", "advisor"),
    (r"\b(investor|partner\s+at)\b", "investor"),
    (r"\b(early\s+employee|first\s+hire|employee\s+#?\d)\b", "early_employee"),
)
GRAD_YEAR = r"(?:class\s+of\s+|graduated\s+in\s+|',?|\b)((?:19|20)\d{2})\b"


def is_missing(c: Column) -> Column:
    """Missing in the sense of the record validator."""
    return c.isNull() | c.cast("string").isin(*MISSING_WORDS)


def money_typed(c: Column) -> Column:
    """Whole dollars out of the first number in the text; struct(value, error)."""
    s = strip(text(c))
    digits = F.replace(F.regexp_extract(s, MONEY, 1), F.lit(","), F.lit(""))
    unit = F.upper(F.regexp_extract(s, MONEY, 2))
    factor = mapped(unit, {"K": "1000", "M": "1000000", "B": "1000000000"}, F.lit("1")).cast("double")
    value = F.when(digits != "", F.floor(digits.cast("double") * factor).cast("long"))
    empty = text(c) == ""
    error = F.when(~empty & value.isNull(), F.concat(F.lit("cannot parse money: "), quoted(text(c))))
    return F.struct(F.when(~empty, value).alias("value"), error.alias("error"))


def float_text(c: Column) -> Column:
    """A double as plain digits: 6000000000000.0 rather than 6.0E12."""
    return F.when(
        (F.abs(c) < 1e16) & (c == F.floor(c)), F.format_string("%.1f", c)
    ).otherwise(c.cast("string"))


def money_lenient(c: Column, field: str = "") -> Column:
    """Dollars as a double out of "$12M", "12.5 million", "~1.2B"; struct(value, issue)."""
    raw = text(c)
    s = F.lower(strip(raw))
    for token in ("$", ",", "usd"):
        s = F.replace(s, F.lit(token), F.lit(""))
    words = r"\b(?:approx|around|over|under|about|circa)\b"

    def parse(stripped: Column) -> Column:
        bare = strip(F.regexp_replace(F.regexp_replace(stripped, r"[+~]+", ""), words, ""))
        return F.struct((is_missing(c) | (stripped == "")).alias("nothing"), let(bare, scaled).alias("value"))

    def scaled(bare: Column) -> Column:
        amount, factor = bare, F.lit(1.0)
        # The outermost unit of the nesting wins: thousands are looked for first.
        for letter, word, f in (
            ("t", " trillion", 1e12), ("b", " billion", 1e9), ("m", " million", 1e6), ("k", " thousand", 1e3),
        ):
            hit = F.endswith(bare, F.lit(letter)) | F.endswith(bare, F.lit(word))
            cut = strip(F.replace(F.regexp_replace(bare, letter + "+$", ""), F.lit(word), F.lit("")))
            amount = F.when(hit, cut).otherwise(amount)
            factor = F.when(hit, F.lit(f)).otherwise(factor)
        return let(amount, lambda a: F.when(a.rlike(NUMBER), a.try_cast("double"))) * factor

    def judge(p: Column) -> Column:
        value = p["value"]
        wrong = (value < 0) | (value > FUNDING_MAX)
        issue = (
            F.when(p["nothing"], F.lit(None).cast("string"))
            .when(value.isNull(), F.concat(F.lit("could not parse funding_total_usd: "), quoted(raw)))
            .when(wrong, F.concat(F.lit("funding_total_usd out of plausible range: "), float_text(value)))
        )
        prefixed = F.concat(F.lit(f"{field}: "), issue) if field else issue
        return F.struct(F.when(~p["nothing"] & ~wrong, value).alias("value"), prefixed.alias("issue"))

    return let(let(strip(s), parse), judge)


def money_number(c: Column) -> Column:
    """The same struct for a column that is a number already."""
    value = c.cast("double")
    wrong = (value < 0) | (value > FUNDING_MAX)
    issue = F.when(wrong, F.concat(F.lit("funding_total_usd out of plausible range: "), float_text(value)))
    return F.struct(F.when(~wrong, value).alias("value"), issue.alias("issue"))


def year_number(c: Column) -> Column:
    ok = c.between(1800, 2030)
    issue = F.when(~ok, F.concat(F.lit("year out of plausible range (1800-2030): "), c.cast("string")))
    return F.struct(F.when(ok, c.cast("int")).alias("value"), issue.alias("issue"))


def _whole(c: Column) -> Column:
    s = strip(text(c))
    return F.when(s.rlike(INTEGER), s.try_cast("long"))


def year_lenient(c: Column) -> Column:
    """Year 1800..2030; struct(value, issue)."""
    y = _whole(c)
    missing = is_missing(c)
    ok = y.between(1800, 2030)
    issue = (
        F.when(missing | ok, F.lit(None).cast("string"))
        .when(y.isNull(), F.concat(F.lit("unparseable year: "), quoted(text(c))))
        .otherwise(F.concat(F.lit("year out of plausible range (1800-2030): "), y.cast("string")))
    )
    return F.struct(F.when(~missing & ok, y.cast("int")).alias("value"), issue.alias("issue"))


def year_typed(c: Column) -> Column:
    """Year 1700..2030; struct(value, error)."""
    y = _whole(c)
    empty = text(c) == ""
    ok = y.between(1700, 2030)
    error = (
        F.when(empty | ok, F.lit(None).cast("string"))
        .when(y.isNull(), F.concat(F.lit("cannot parse year: "), quoted(text(c))))
        .otherwise(F.concat(F.lit("year "), y.cast("string"), F.lit(" out of plausible range")))
    )
    return F.struct(F.when(~empty & ok, y.cast("int")).alias("value"), error.alias("error"))


def count_range(c: Column) -> Column:
    """Head count out of "51-200" (floor of the mean), "25+" or "5,000"; struct(value, error)."""
    s = strip(text(c))
    missing = (s == "") | F.lower(s).isin(*MISSING_NUMBER)
    span = r"^([\d,]+)\s*[-–to]+\s*([\d,]+)\+?$"

    def number(x: Column) -> Column:
        digits = F.replace(x, F.lit(","), F.lit(""))
        return F.when(digits.rlike(INTEGER), digits.try_cast("long"))

    lo, hi = number(F.regexp_extract(s, span, 1)), number(F.regexp_extract(s, span, 2))
    plus = number(F.regexp_extract(s, r"^([\d,]+)\+$", 1))
    value = (
        F.when(missing, F.lit(None).cast("long"))
        .when(s.rlike(span), F.floor((lo + hi) / 2).cast("long"))
        .when(s.rlike(r"^([\d,]+)\+$"), plus)
        .otherwise(number(s))
    )
    error = F.when(
        ~missing & value.isNull() & ~s.rlike(span) & ~s.rlike(r"^([\d,]+)\+$"),
        F.concat(F.lit("cannot parse int: "), quoted(text(c))),
    )
    return F.struct(value.alias("value"), error.alias("error"))


def bool3(c: Column) -> Column:
    """yes / no / don't know."""
    s = F.lower(strip(text(c)))
    return F.when(s.isin("true", "yes", "y"), F.lit(True)).when(s.isin("false", "no", "n"), F.lit(False))


def yes_no_unknown(c: Column) -> Column:
    return F.when(c, "Yes").when(~c, "No").otherwise("Unknown")


def funding_stage(c: Column) -> Column:
    s = F.replace(F.lower(strip(text(c))), F.lit(" "), F.lit("-"))
    return F.when(s.isin(*STAGES), s).otherwise(mapped(s, STAGE_VARIANTS, F.lit(None).cast("string")))


def status(c: Column, is_public: Column) -> Column:
    return F.when(F.coalesce(is_public, F.lit(False)), F.lit("ipo")).otherwise(
        mapped(F.lower(strip(text(c))), STATUS_MAP, F.lit("unknown"))
    )


def person_role(c: Column) -> Column:
    return first_match(c, ROLE_PATTERNS, "alumnus")


def company_role(c: Column, default: str = "founder") -> Column:
    return first_match(c, COMPANY_ROLE_PATTERNS, default)


def school(c: Column, patterns, fallback: tuple[str, str]) -> Column:
    return first_match(c, tuple(patterns) + (fallback,), "unknown")


def grad_year(c: Column) -> Column:
    """First 19xx or 20xx year in the text, if plausible."""
    y = F.regexp_extract(text(c), "(?U)" + GRAD_YEAR, 1)
    year = F.when(y != "", y.try_cast("int"))
    return F.when(year.between(1860, 2030), year)


def http_class(c: Column) -> Column:
    return (
        F.when(c == 200, "ok")
        .when(c == 429, "long_backoff")
        .when(c.between(500, 599), "retryable")
        .when(c.between(400, 499), "fatal")
        .otherwise("retryable")
    )

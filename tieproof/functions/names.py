"""The four name keys, and the tests and splits of people names.

The keys are kept apart on purpose: the store key keeps words such as
"holdings", the canonical key drops them, the short one drops fewer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tieproof.functions.text import NOT_WORD_OR_WS, WS, squeeze, strip, text

# Legal-form suffixes of each key.
TRAILING_FORM = WS + r"*,?" + WS + r"*(?:inc\.?|llc\.?|ltd\.?|corp\.?|co\.?|plc\.?)$"
FORM_WORDS = (
    r"\b(?:inc\.?|incorporated|llc|l\.l\.c\.|ltd\.?|limited|corp\.?|corporation|"
    r"co\.?|company|gmbh|s\.a\.|s\.r\.l\.|plc|holdings?|technologies|"
    r"labs?|industries|systems)\b"
)
FORM_WORDS_SHORT = r"\b(?:inc\.?|llc|ltd\.?|corp\.?|corporation|co\.?|company)\b"
PAREN = r"\([^)]*\)"

# Words that stand where a person's name should.
NOT_A_PERSON = ("unknown", "n/a", "tbd", "anonymous", "various")
NOT_A_FOUNDER = ("none", "unknown", "n/a")
HUMAN_NAME = r"^[A-ZÀ-Ý][\p{L}\p{N}_.'\-]+(?:" + WS + r"+[A-ZÀ-Ý][\p{L}\p{N}_.'\-]+)+$"
PEOPLE_SEPARATORS = r",|;| and | & "


def name_key(c: Column) -> Column:
    """Key of the record store."""
    n = F.lower(strip(text(c)))
    n = F.regexp_replace(n, TRAILING_FORM, "")
    return squeeze(F.regexp_replace(n, NOT_WORD_OR_WS, ""))


def _canonical(c: Column, forms: str) -> Column:
    n = F.regexp_replace(F.lower(text(c)), PAREN, " ")
    n = F.regexp_replace(n, "(?U)" + forms, " ")
    n = squeeze(F.regexp_replace(n, NOT_WORD_OR_WS, " "))
    return F.regexp_replace(n, r"^the ", "")


def canonical_name(c: Column) -> Column:
    """Key under which spelling variants of one company fall together."""
    return _canonical(c, FORM_WORDS)


def canonical_name_short(c: Column) -> Column:
    """The weaker variant used to compare article titles with known names."""
    return _canonical(c, FORM_WORDS_SHORT)


def lower_key(c: Column) -> Column:
    return F.lower(strip(text(c)))


def is_human_name(c: Column) -> Column:
    """Two or more capitalised words; the placeholder words are single and so never pass."""
    n = strip(text(c))
    return F.contains(n, F.lit(" ")) & n.rlike(HUMAN_NAME)


def last_name(c: Column) -> Column:
    """Last whitespace token, lower case; empty when there is none."""
    return F.lower(F.regexp_extract(text(c), r"([^\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]+)" + WS + r"*$", 1))


def split_people(c: Column) -> Column:
    """Names in a free-text list, without one-letter and placeholder entries."""
    parts = F.transform(F.split(text(c), PEOPLE_SEPARATORS), strip)
    return F.filter(parts, lambda n: (F.length(n) >= 2) & ~F.lower(n).isin(*NOT_A_FOUNDER))


def to_tags(c: Column) -> Column:
    return F.filter(F.transform(F.split(text(c), "[,;/]"), strip), lambda t: t != "")

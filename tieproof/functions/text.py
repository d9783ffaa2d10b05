"""Text normalisation shared by every rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes spelled out so that they mean the same in every engine.
WS_CHARS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    + "".join(chr(cp) for cp in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"
NOT_WORD_OR_WS = r"[^\p{L}\p{N}_\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"


def ci(pattern: str) -> str:
    """Case-insensitive, with Unicode-aware ``\\w``, ``\\s`` and ``\\b``."""
    return "(?iU)" + pattern


def let(c: Column, body) -> Column:
    """``body(c)`` with ``c`` computed once, for chains that use a value many times."""
    return F.get(F.transform(F.array(c), body), F.lit(0))


def once(c: Column) -> Column:
    """``c`` as a generated column.

    For costly expressions that later filters refer to: a filter is not pushed
    below a generator it reads from, so the value is worked out once per row
    instead of once more in every filter.
    """
    return F.explode(F.array(c))


def text(c: Column) -> Column:
    """The text, with null read as the empty string."""
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, WS + "+", " "))


def cut(c: Column, max_chars: int | None) -> Column:
    """The first ``max_chars`` characters; the whole text for None."""
    return c if max_chars is None else F.substring(c, 1, max_chars)


def is_blank(c: Column) -> Column:
    return strip(text(c)) == ""


def normalize_text(c: Column) -> Column:
    return squeeze(F.lower(text(c)))


def span_present(span: Column, source: Column) -> Column:
    """True when the claimed span occurs in the source, blank spans never do."""
    return ~is_blank(span) & F.contains(normalize_text(source), normalize_text(span))


def short_hash(c: Column, n: int = 8) -> Column:
    return F.substring(F.sha2(c, 256), 1, n)


def quoted(c: Column) -> Column:
    """A value quoted for a message: single quotes unless it holds some."""
    has_single, has_double = F.contains(c, F.lit("'")), F.contains(c, F.lit('"'))
    escaped = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    return F.when(
        has_single & ~has_double,
        F.concat(F.lit('"'), F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"')),
    ).otherwise(F.concat(F.lit("'"), escaped, F.lit("'")))


def first_match(c: Column, rules, default: str, empty: str | None = None) -> Column:
    """Label of the first ``(pattern, label)`` that occurs in the text."""
    pairs = [(F.lit(False), "")] if not rules else [(c.rlike(ci(p)), label) for p, label in rules]
    chain = reduce(lambda acc, r: acc.when(r[0], r[1]), pairs[1:], F.when(*pairs[0]))
    return F.when(text(c) == "", F.lit(default if empty is None else empty)).otherwise(chain.otherwise(default))


def mapped(c: Column, mapping: dict[str, str], default: Column) -> Column:
    """Look a value up in a small fixed table."""
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(table, c), default)

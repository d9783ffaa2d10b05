"""Secrets in texts, found through a trigram index.

From each rule's regular expression a Boolean query over trigrams is derived
that every match satisfies. A batch of documents is indexed as a segment:
postings of just those trigrams that some query names. The postings are
intersected and united as the query says, and the candidates are verified with
the expression itself. A rule without a mandatory trigram scans every text.

Trigrams are taken over bytes with A-Z in lower case, so one index serves rules
in either case.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieproof.llm.tables import query, table
from tieproof.llm.words import LOWER, chunks, text_bytes

#: Above so many strings a set of exact strings is given up (its trigrams are kept).
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds a match; it counts if ``group`` of it has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    ignore_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


# fixed values: the three base rules
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
# fixed values: public token formats
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

# --- Boolean trigram queries ---------------------------------------------------
# A query is True (no condition), ("and", parts), ("or", parts) or a trigram (bytes).


def _and(parts):
    parts = {p for p in parts if p is not True}
    return True if not parts else next(iter(parts)) if len(parts) == 1 else ("and", frozenset(parts))


def _terms(q):
    return q[1] if isinstance(q, tuple) and q[0] == "and" else frozenset([q])


def _or(parts):
    parts = set(parts)
    if True not in parts:  # a part that asks for more than another adds nothing
        parts = {p for p in parts if not any(_terms(o) < _terms(p) for o in parts)}
    return True if True in parts or not parts else next(iter(parts)) if len(parts) == 1 else ("or", frozenset(parts))


def _of_strings(strings):
    """What a text holds if it holds one of ``strings``."""
    return _or(_and(s[i:i + 3] for i in range(len(s) - 2)) for s in strings)


class _Need:
    """``exact``: the strings an expression can match, if few; ``need``: the query that any match satisfies."""

    def __init__(self, exact=None, need=True):
        self.exact, self.need = exact, need

    def query(self):
        return _and([self.need, _of_strings(self.exact) if self.exact is not None else True])


def _class_strings(items):
    chars = set()
    for op, arg in items:
        if op is sre.LITERAL:
            chars.add(arg)
        elif op is sre.RANGE and arg[1] - arg[0] < MOST_STRINGS:
            chars.update(range(arg[0], arg[1] + 1))
        else:
            return None
    return {chr(c).lower().encode() for c in chars} if len(chars) <= MOST_STRINGS and max(chars) < 128 else None


def _joined(a: _Need, b: _Need) -> _Need:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MOST_STRINGS:
        return _Need({x + y for x in a.exact for y in b.exact}, _and([a.need, b.need]))
    return _Need(None, _and([a.query(), b.query()]))


def _analyse(tokens) -> _Need:
    """Runs of exact strings are joined as far as they stay few; a run that ends gives its trigrams."""
    out, run, whole = True, _Need({b""}), True
    for op, arg in tokens:
        if op is sre.LITERAL:
            one = _Need({chr(arg).lower().encode()} if arg < 128 else None)
        elif op is sre.IN:
            one = _Need(_class_strings(arg))
        elif op is sre.SUBPATTERN:
            one = _analyse(arg[3])
        elif op is sre.BRANCH:
            ways = [_analyse(w) for w in arg[1]]
            if all(w.exact is not None for w in ways) and sum(len(w.exact) for w in ways) <= MOST_STRINGS:
                one = _Need(set().union(*(w.exact for w in ways)), _or(w.need for w in ways))
            else:
                one = _Need(None, _or(w.query() for w in ways))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, inner = arg
            part = _analyse(inner)
            if most == 1 and least == 0 and part.exact is not None:
                one = _Need(part.exact | {b""})
            elif least >= 1:
                one = part if least == most == 1 else _Need(None, part.query())
            else:
                one = _Need(None, True)
        elif op is sre.AT:
            continue
        else:
            one = _Need(None, True)
        if run.exact is not None and one.exact is not None and len(run.exact) * len(one.exact) <= MOST_STRINGS:
            run = _joined(run, one)
        else:
            out, whole = _and([out, run.query()]), False
            run = one if one.exact is not None else _Need({b""}, one.need)
    return run if whole else _Need(None, _and([out, run.query()]))


def trigram_query(rule: Rule):
    """A Boolean query over lower-case trigrams that each match of the rule satisfies; True if there is none."""
    return _analyse(parser.parse(rule.pattern, re.ASCII)).query()


def _trigrams(q) -> set[bytes]:
    return set() if q is True else {q} if isinstance(q, bytes) else set().union(*map(_trigrams, q[1]))


class Segment:
    """Postings of chosen trigrams over a chunk of texts."""

    def __init__(self, texts: pa.Array, known: np.ndarray, slot: np.ndarray):
        raw, bounds = text_bytes(texts)
        self.n = len(texts)
        low = LOWER[raw].astype(np.uint32)
        code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:] if len(low) > 2 else np.zeros(0, np.uint32)
        at = np.flatnonzero(known[code])
        doc = np.searchsorted(bounds, at, side="right") - 1
        inside = at + 3 <= bounds[doc + 1]
        pairs = np.unique(slot[code[at[inside]]].astype(np.int64) * self.n + doc[inside])
        which, self.doc = np.divmod(pairs, max(1, self.n))
        self.first = np.searchsorted(which, np.arange(slot.max(initial=0) + 2))

    def postings(self, k: int) -> np.ndarray:
        return self.doc[self.first[k]:self.first[k + 1]]

    def find(self, q, slots: dict[bytes, int]) -> np.ndarray:
        """Rows that satisfy the query, in order."""
        if q is True:
            return np.arange(self.n)
        if isinstance(q, bytes):
            return self.postings(slots[q])
        found = sorted((self.find(p, slots) for p in q[1]), key=len)
        out = found[0]
        for f in found[1:]:
            out = np.intersect1d(out, f, assume_unique=True) if q[0] == "and" else np.union1d(out, f)
        return out


class Scanner:
    """Finds the spans of all rules in batches of texts."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = [(r.kind, r.compiled(), r.group, r.least, trigram_query(r)) for r in rules]
        grams = sorted(set().union(*(_trigrams(r[-1]) for r in self.rules)))
        self.slots = {g: i for i, g in enumerate(grams)}
        self.known, self.slot = np.zeros(1 << 24, bool), np.zeros(1 << 24, np.uint16)
        for g, i in self.slots.items():
            code = g[0] << 16 | g[1] << 8 | g[2]
            self.known[code], self.slot[code] = True, i

    def spans(self, texts: pa.Array) -> list[list[tuple[int, int, str]]]:
        """Of each text its (start, end, kind) by start, then in the order of the rules; in code points."""
        out: list[list[tuple[int, int, str]]] = []
        for lo, hi in chunks(texts):
            part = texts.slice(lo, hi - lo)
            segment, strings = Segment(part, self.known, self.slot), part.to_pylist()
            found: list[list[tuple[int, int, int]]] = [[] for _ in strings]
            for order, (_, pattern, group, least, q) in enumerate(self.rules):
                for d in segment.find(q, self.slots).tolist():
                    for m in pattern.finditer(strings[d] or ""):
                        if m.end(group) - m.start(group) >= least:
                            found[d].append((m.start(), order, m.end()))
            out += [[(s, e, self.rules[k][0]) for s, k, e in sorted(f)] for f in found]
        return out


SPANS = "array<struct<start: int, end: int, kind: string>>"


def find_secrets(documents: DataFrame, rules: Sequence[Rule] = BASE + MORE) -> DataFrame:
    """``doc_id, spans`` of every row of ``documents`` (``doc_id``, ``text``); a null or empty text has no span.

    Spans are (start, end, kind), code points, end exclusive, by start and then
    in the order of the rules. Rows keep their number and ids, null ids too;
    texts are scanned whole. Nothing is shuffled.
    """
    rules = tuple(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
        for b in batches:
            rows = [[{"start": s, "end": e, "kind": k} for s, e, k in spans] for spans in scanner.spans(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind)], ["doc_id", "spans"])

    docs = documents.select("doc_id", "text")
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, spans {SPANS}")


def mask(text: str, spans: Sequence[tuple[int, int, str]]) -> str:
    """The text with each stretch covered by spans replaced by ``[kind]`` of its first span."""
    out, at = [], 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_secrets(documents: DataFrame, rules: Sequence[Rule] = BASE + MORE) -> DataFrame:
    """``documents`` with secrets in ``text`` masked and ``n_chars`` (if there is one) set anew; all rows and columns stay."""
    rules, schema = tuple(rules), documents.schema
    at = documents.columns.index("text")
    n_at = documents.columns.index("n_chars") if "n_chars" in documents.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for b in batches:
            columns, spans = b.columns, scanner.spans(b.column(at))
            texts = b.column(at).to_pylist()
            changed = [d for d, s in enumerate(spans) if s]
            for d in changed:
                texts[d] = mask(texts[d], spans[d])
            columns[at] = pa.array(texts, b.schema.field(at).type)
            if n_at is not None and changed:
                n = b.column(n_at).to_pylist()
                for d in changed:
                    n[d] = len(texts[d])
                columns[n_at] = pa.array(n, b.schema.field(n_at).type)
            yield pa.RecordBatch.from_arrays(columns, b.schema.names)

    return documents.mapInArrow(run, schema)


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


@query("op7_secret_scan")
def op7_secret_scan(spark, folder):
    found = find_secrets(table(spark, folder, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*[r.kind for r in BASE]))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(text(base), 256).alias("base_sha256"),
                        text(F.col("spans")).alias("spans"))

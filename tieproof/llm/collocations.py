"""Phrase collocations: Misra-Gries summaries of all n-grams, merged per hash partition, then exact counts.

1. Each task counts the n-grams of its texts by hash and sends, per hash
   partition, a summary: sorted hashes as differences, counts where above one.
2. A partition merges its summaries as they come. Its mass is known first, and it
   keeps more counters than mass divided by the asked count, so what pruning takes
   off any counter stays below that count: every frequent n-gram survives.
3. Survivors set bits in a bitmap of bounded size. A second reading of the texts
   counts the n-grams that hit it, by their words; a bit set by chance only costs
   a row that the exact count then drops.
4. Scores, absorbed phrases and ranks are joins and windows over the frequent ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieproof.llm.tables import partitions, query, saved, table
from tieproof.llm.words import LOWER, SPACE, Words, chunks, split
from tieproof.llm.words import _mixed as mixed

#: Occurrences that a task holds before it sends their summaries, and entries that a partition merges at once.
LOCAL = 6 << 20
MERGE = 1 << 20
KEY_BITS = 40
#: Bytes of text for each hash partition; there are four to a shuffle partition at least.
TEXT_PER_PART = 1 << 24
#: Bound of the bitmap of survivors, in bits (a power of two).
BITMAP_BITS = 26
TEXTS = 1 << 22
#: Counted phrases that a task holds before it sends them.
HELD = 1 << 20

_CUT = np.zeros(256, np.int64)
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = 1
_BREAK = SPACE | (_CUT > 0)
_FOLD = LOWER.copy()
_FOLD[9] = 32
_WEIGHT = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


# --- n-grams of a chunk of texts ------------------------------------------------


def _langs(column: pa.Array, missing: str) -> tuple[np.ndarray, list[str]]:
    coded = pc.fill_null(column.cast(pa.string()), missing).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


class Chunk:
    """Words of some texts, the piece and the language that each is in."""

    def __init__(self, texts: pa.Array, langs: pa.Array, missing: str):
        self.words: Words = split(texts, _FOLD, _BREAK)
        w = self.words
        docs = np.repeat(np.arange(len(texts)), np.diff(w.first))
        # both grow along the chunk, so their sum changes with either
        self.piece = np.cumsum(_CUT[w.data])[w.start] + docs if len(docs) else docs
        codes, self.names = _langs(langs, missing)
        self.lang = codes[docs]
        salt = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.names]
        self.salt = np.array(salt, np.uint64)[self.lang] if len(docs) else np.zeros(0, np.uint64)

    def grams(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, first words, hashes) of all runs of 1 to ``longest`` words inside pieces."""
        h = self.words.hashes()
        total = self.salt.copy()
        for n in range(1, longest + 1):
            m = len(h) - n + 1
            if m <= 0:
                return
            total = total[:m] + h[n - 1:] * _WEIGHT[n]
            at = np.flatnonzero(self.piece[:m] == self.piece[n - 1:])
            yield n, at, mixed(total[at] + np.uint64(n))

    def phrases(self, first: np.ndarray, n: int) -> pa.Array:
        """The runs of ``n`` words from each of ``first``, joined by single spaces."""
        w = self.words
        start, end = w.start[first], w.end[first + n - 1]
        inner = sum((w.end[first + k] - w.start[first + k] for k in range(n)), np.zeros(len(first), np.int64)) + n - 1
        plain = end - start == inner
        size = np.where(plain, inner, 0)
        to = np.concatenate([[0], np.cumsum(size)])
        data = w.data[np.repeat(start - to[:-1], size) + np.arange(to[-1])]
        out = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(to.astype(np.int64)), pa.py_buffer(data)])
        odd = np.flatnonzero(~plain)
        if len(odd):
            joined = [b" ".join(w.data[w.start[i + k]:w.end[i + k]].tobytes() for k in range(n)).decode() for i in first[odd].tolist()]
            out = pc.replace_with_mask(out, pa.array(~plain), pa.array(joined, pa.large_string()))
        return out


def _chunks(batches: Iterator[pa.RecordBatch], size: int, missing: str) -> Iterator[Chunk]:
    for b in batches:
        for lo, hi in chunks(b.column(0), size):
            yield Chunk(b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), missing)


# --- summaries -------------------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers as groups of seven bits, the lowest first."""
    v = values.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 10):
        size += v >= np.uint64(1) << np.uint64(7 * k)
    to = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(to[-1], np.uint8)
    for k in range(int(size.max(initial=0))):
        at = np.flatnonzero(size > k)
        more = np.where(size[at] > k + 1, 128, 0)
        out[to[at] + k] = ((v[at] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | more.astype(np.uint8)
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    first = np.concatenate([[0], np.flatnonzero(raw < 128)[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(first, np.diff(np.append(first, len(raw))))
    return np.add.reduceat((raw & 127).astype(np.uint64) << (7 * place).astype(np.uint64), first)


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often, or with how much, each is there."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    total = np.diff(np.append(first, len(keys))) if counts is None else np.add.reduceat(counts, first) if len(first) else counts
    return keys[first], total


class Summary:
    """Misra-Gries over (key, count): ``upper`` is never below the true count of a key that is kept, and a key whose
    true count is above ``taken`` is always kept. ``taken`` is at most mass / (capacity + 1)."""

    def __init__(self, capacity: int):
        self.capacity, self.taken, self.waiting, self.held = capacity, 0, [], 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.held += len(keys)
        if self.held >= max(MERGE, 2 * self.capacity):
            self.merge()
            self.prune()

    def merge(self) -> None:
        parts = [(self.keys, self.counts), *self.waiting]
        self.keys, self.counts = counted(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
        self.waiting, self.held = [], 0

    def prune(self) -> None:
        over = len(self.keys) - self.capacity
        if over > 0:
            cut = int(np.partition(self.counts, over - 1)[over - 1])
            keep = self.counts > cut
            self.keys, self.counts, self.taken = self.keys[keep], self.counts[keep] - cut, self.taken + cut

    def survivors(self, least: int) -> np.ndarray:
        self.merge()
        return self.keys[self.counts + self.taken >= least]


def summaries(documents: DataFrame, longest: int, part_bits: int, missing: str, local: int = LOCAL) -> DataFrame:
    """``part, kind, mass, hashes, counts``: per hash partition and task its mass (kind 0) and its summary (kind 1)."""
    key_mask = np.uint64((1 << KEY_BITS) - 1)

    def sent(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = counted(np.concatenate(held))
        part = (keys >> np.uint64(KEY_BITS)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        rows: list[list] = [[], [], [], [], []]
        for lo, hi in zip(first, [*first[1:], len(keys)]):
            k, c = keys[lo:hi] & key_mask, counts[lo:hi]
            step = np.diff(k, prepend=np.uint64(0)) << np.uint64(1) | (c > 1).astype(np.uint64)
            mass = int(c.sum())
            for kind, a, b in ((0, None, None), (1, packed(step), packed(c[c > 1] - 2))):
                for column, value in zip(rows, (int(part[lo]), kind, mass, a, b)):
                    column.append(value)
        types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], ["part", "kind", "mass", "hashes", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for chunk in _chunks(batches, 1 << 21, missing):
            for _, _, g in chunk.grams(longest):
                held.append(g >> np.uint64(64 - KEY_BITS - part_bits))
                n += len(g)
            if n >= local:
                yield sent(held)
                held, n = [], 0
        if n:
            yield sent(held)

    return documents.mapInArrow(run, "part int, kind int, mass long, hashes binary, counts binary")


def _dealt(rows: DataFrame, part_bits: int, second: str) -> DataFrame:
    """Rows by hash partition, a few of those to a task, however many there are."""
    tasks = max(partitions(rows.sparkSession), (1 << part_bits) // 4)
    return rows.repartition(tasks, "part").sortWithinPartitions("part", second)


def survivors(documents: DataFrame, least: int, longest: int, part_bits: int, missing: str, local: int = LOCAL) -> DataFrame:
    """``gram``: shortened hashes of n-grams, among them all that occur ``least`` times."""
    parts = summaries(documents, longest, part_bits, missing, local)
    dealt = _dealt(parts, part_bits, "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = None, 0, None

        def out() -> pa.RecordBatch:
            found = summary.survivors(least) | (np.uint64(part) << np.uint64(KEY_BITS)) if summary else np.zeros(0, np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["gram"])

        for b in batches:
            for p, kind, m, hashes, counts in zip(*(c.to_pylist() for c in b.columns)):
                if p != part:
                    if part is not None:
                        yield out()
                    part, mass, summary = p, 0, None
                if kind == 0:
                    mass += m
                    continue
                summary = summary or Summary(mass // least + 1)
                step = unpacked(hashes)
                n = np.ones(len(step), np.int64)
                n[(step & np.uint64(1)) == 1] = unpacked(counts).astype(np.int64) + 2
                summary.add(np.cumsum(step >> np.uint64(1), dtype=np.uint64), n)
        if part is not None:
            yield out()

    return dealt.mapInArrow(run, "gram long")


def _slots(gram: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.uint64(64 - bits)
    return mixed(gram) >> up, mixed(gram ^ np.uint64(0x9E3779B97F4A7C15)) >> up


def bitmap(grams: DataFrame, most_bits: int = BITMAP_BITS) -> np.ndarray:
    """Two bits of every ``gram``; 32 bits a gram as long as the bound allows. At most 2 ** ``most_bits`` bits reach the driver."""
    n = grams.count()
    bits = min(most_bits, max(12, (32 * n).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = np.concatenate(_slots(b.column(0).to_numpy().view(np.uint64), bits))
            word, which = np.unique(slot >> np.uint64(6), return_inverse=True)
            value = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(value, which, np.uint64(1) << (slot & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(value.view(np.int64))], ["word", "bits"])

    rows = grams.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def _set(map_: np.ndarray, gram: np.ndarray) -> np.ndarray:
    hit = np.ones(len(gram), bool)
    for slot in _slots(gram, 6 + len(map_).bit_length() - 1):
        hit &= (map_[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
    return hit


# --- exact counts and scores -------------------------------------------------------


def counts_of(documents: DataFrame, known: np.ndarray, least: int, longest: int, part_bits: int, missing: str,
              texts: int = TEXTS) -> DataFrame:
    """``lang, phrase, f``: exact counts of the phrases that occur ``least`` times; the empty phrase counts all words.

    A task sends what it counted as one row per hash partition and language: the
    phrases, a line each, and their counts. Partitions add them up by their text.
    """

    def sent(held: list[pa.Table], totals: dict[str, int]) -> pa.RecordBatch:
        rows: list[list] = [[0] * len(totals), list(totals), [b""] * len(totals), [packed(np.array([n])) for n in totals.values()]]
        if held:
            t = pa.concat_tables(held)
            gram, first, which = np.unique(t.column("gram").to_numpy(), return_index=True, return_inverse=True)
            f = np.bincount(which, t.column("f").to_numpy(), len(gram)).astype(np.int64)
            part = (gram >> np.uint64(64 - part_bits)).astype(np.int64)
            t = t.select(["lang", "phrase"]).take(pa.array(first))
            code, names = _langs(t.column("lang").combine_chunks(), missing)
            order = np.lexsort((code, part))
            part, code, f = part[order], code[order], f[order]
            phrases = t.column("phrase").take(pa.array(order)).to_pylist()
            start = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (code[1:] != code[:-1])])) if len(part) else []
            for lo, hi in zip(start, [*start[1:], len(part)]):
                for column, value in zip(rows, (int(part[lo]), names[code[lo]], "\n".join(phrases[lo:hi]).encode(), packed(f[lo:hi]))):
                    column.append(value)
        types = (pa.int32(), pa.string(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], ["part", "lang", "phrases", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held, totals = [], 0, {}
        for chunk in _chunks(batches, texts, missing):
            names = pa.array(chunk.names, pa.string())
            for name, n in zip(chunk.names, np.bincount(chunk.lang, minlength=len(names)).tolist()):
                totals[name] = totals.get(name, 0) + n
            for n, at, g in chunk.grams(longest):
                hit = _set(known, g >> np.uint64(64 - KEY_BITS - part_bits))
                at, g = at[hit], g[hit]
                gram, first, times = np.unique(g, return_index=True, return_counts=True)
                held.append(pa.table({"gram": gram, "lang": names.take(pa.array(chunk.lang[at[first]])),
                                      "phrase": chunk.phrases(at[first], n), "f": times}))
                n_held += len(gram)
            if n_held >= HELD:
                yield sent(held, totals)
                held, n_held, totals = [], 0, {}
        yield sent(held, totals)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, {}

        def out() -> pa.RecordBatch:
            found = [(p.decode(), n) for p, n in total.items() if n >= least or (not p and n)]
            return pa.RecordBatch.from_arrays([
                pa.array([key[1]] * len(found), pa.string()), pa.array([p for p, _ in found], pa.string()),
                pa.array([n for _, n in found], pa.int64())], ["lang", "phrase", "f"])

        for b in batches:
            for part, lang, phrases, counts in zip(*(c.to_pylist() for c in b.columns)):
                if (part, lang) != key:
                    if key is not None:
                        yield out()
                    key, total = (part, lang), {}
                for p, n in zip(phrases.split(b"\n"), unpacked(counts).tolist()):
                    total[p] = total.get(p, 0) + n
        if key is not None:
            yield out()

    rows = documents.mapInArrow(run, "part int, lang string, phrases binary, counts binary")
    return _dealt(rows, part_bits, "lang").mapInArrow(add, "lang string, phrase string, f long")


def frequent_phrases(documents: DataFrame, least: int = 100, longest: int = 5, missing: str = "und", most_bits: int = BITMAP_BITS,
                     local: int = LOCAL, texts: int = TEXTS) -> DataFrame:
    """``lang, phrase, f`` of every phrase of 1 to ``longest`` words that occurs ``least`` times in its ``lang``.

    The empty phrase holds the number of all words of the language. Texts are
    lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and those into
    words at spaces and tabs; phrases lie inside pieces, overlaps count. Null
    texts are empty, rows without ``lang`` count as ``missing``, repeated rows
    count as often as they are there. An empty table has no rows.

    Equal 64-bit hashes inside one task are taken for equal phrases.
    """
    spark = documents.sparkSession
    docs = documents.select("text", F.col("lang").cast("string").alias("lang"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    part_bits = min(24, max(4 * partitions(spark), -(-size // TEXT_PER_PART)).bit_length())
    known = bitmap(saved(survivors(docs, least, longest, part_bits, missing, local)), most_bits)
    return counts_of(docs, known, least, longest, part_bits, missing, texts)


def floor_ratio(factor: int, a: Column, n: Column, left: Column, right: Column) -> Column:
    """``floor(factor * a * n / (left * right))`` in whole numbers of up to 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    top = (F.lit(factor).cast("decimal(5,0)") * wide(a)).cast("decimal(19,0)") * wide(n)
    return F.call_function("div", top, wide(left) * wide(right))


def scored(frequent: DataFrame, absorb: int = 100) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of the phrases of two words and more in ``frequent`` (of :func:`frequent_phrases`).

    Each cut of a phrase into ``l`` and ``r`` has the score floor(1000 a n / (l r));
    the lowest counts, of equal ones that with the shortest left part. Phrases that
    lie inside a longer one go if that has at least ``absorb`` percent of their count.
    """
    parts = frequent.where("phrase <> ''").select("lang", "phrase", F.col("f").alias("a"))
    totals = frequent.where("phrase = ''").select("lang", F.col("f").alias("n"))
    long_ = parts.withColumn("words", F.split("phrase", " ")).where(F.size("words") > 1)
    piece = lambda first, size: F.array_join(F.slice("words", first, size), " ")
    cuts = long_.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1))).select(
        "lang", "phrase", "a", "k", piece(F.lit(1), F.col("k")).alias("left"),
        piece(F.col("k") + 1, F.size("words") - F.col("k")).alias("right"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    cuts = cuts.join(totals, "lang").withColumn("score", floor_ratio(1000, F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    best = cuts.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.size("words") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.size("words") - size + 1), lambda first: F.array_join(F.slice("words", first, size), " "))))
    inner = long_.where(F.size("words") > 2).select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), "a")
    around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = best.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * absorb))
    return kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(documents: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, **options) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language by score, then count, then bytes."""
    found = scored(saved(frequent_phrases(documents, least, longest, **options)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP12_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), runs AS (
  SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM words, (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size
), f AS (
  SELECT lang, array_to_string(w[p:p + size - 1], ' ') AS phrase, size, CAST(count(*) AS BIGINT) AS a FROM runs GROUP BY ALL
), big AS (SELECT * FROM f WHERE a >= 100),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, size, a, string_split(phrase, ' ') AS w FROM big WHERE size > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, size)) AS k FROM cand) c
), scores AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, t.n,
    CAST((1000::HUGEINT * c.a * t.n) // (l.a::HUGEINT * r.a) AS BIGINT) AS score
  FROM cuts c JOIN big l ON l.lang = c.lang AND l.phrase = c.lp JOIN big r ON r.lang = c.lang AND r.phrase = c.rp
  JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS i FROM scores) WHERE i = 1
), spans AS (
  SELECT lang, a, w, size, unnest(range(2, size)) AS s FROM cand WHERE size > 2
), inside AS (
  SELECT lang, array_to_string(w[p:p + s - 1], ' ') AS phrase, max(a) AS around
  FROM (SELECT *, unnest(range(1, size - s + 2)) AS p FROM spans) GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.around IS NULL OR 100 * i.around < 100 * b.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000
"""


@query("op12_collocations", OP12_SQL)
def op12_collocations(spark, folder):
    return collocations(table(spark, folder, "documents", "text", "lang"))

"""Text quality by gradient-boosted trees over statistics of a document.

Statistics are counted for many texts at once. Trees are grown on histograms of
binned statistics, all of the same depth, and kept as flat arrays: node ``i`` has
the children ``2i + 1`` and ``2i + 2``, so a batch walks down all trees in as
many vector steps as the trees are deep.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieproof.llm.tables import bucket_of, query, table
from tieproof.llm.words import SPACE, chunks, shingles, split, text_bytes

_CLASS = {
    "upper": range(65, 91), "digit": range(48, 58), "wide": range(128, 256), "space": np.flatnonzero(SPACE),
    "stop": b".?", "comma": b",;:", "shout": b"!", "bar": b"|", "symbol": b"#$%&*+/<=>@\\^_`{}~", "bracket": b"()[]\"'",
}
_MASKS = {k: np.isin(np.arange(256), list(v)) for k, v in _CLASS.items()}
_PUNCTUATION = np.array([33 <= c < 48 or 58 <= c < 65 or 91 <= c < 97 or 123 <= c < 127 for c in range(256)])
_LINE_END = np.arange(256) == 10
FEATURES = (*_CLASS, "log_words", "mean_length", "long_words", "short_words", "word_ends", "sentence_words", "distinct_words",
            "top_word", "distinct_shingles", "lines", "distinct_lines", "log_longest")


def _per_text(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _distinct(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, count of the commonest) of each text."""
    distinct, top = np.zeros(len(first) - 1), np.zeros(len(first) - 1)
    for d, (lo, hi) in enumerate(zip(first[:-1], first[1:])):
        if hi > lo:
            k = np.sort(keys[lo:hi])
            runs = np.diff(np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1], [True]))))
            distinct[d], top[d] = len(runs), runs.max()
    return distinct, top


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text; an empty or null text has zeros."""
    out = []
    for lo, hi in chunks(texts):
        part = texts.slice(lo, hi - lo)
        raw, bounds = text_bytes(part)
        size = np.maximum(np.diff(bounds), 1)
        words = split(part)
        n = np.diff(words.first)
        many = np.maximum(n, 1)
        length = words.end - words.start
        of = np.repeat(np.arange(len(n)), n)
        by_text = lambda v: np.bincount(of, v, len(n))
        distinct, top = _distinct(words.hashes(), words.first)
        runs = np.array([len(s) for s in shingles(words)])
        lines = split(part, space=_LINE_END)
        n_lines = np.diff(lines.first)
        distinct_lines, _ = _distinct(lines.hashes(), lines.first)
        longest = np.zeros(len(n))
        np.maximum.at(longest, of, length)
        stops = _per_text(_MASKS["stop"][raw] | _MASKS["shout"][raw], bounds)
        columns = [_per_text(m[raw], bounds) / size for m in _MASKS.values()] + [
            np.log1p(n), by_text(length) / many, by_text(length > 14) / many, by_text(length <= 3) / many,
            by_text(_PUNCTUATION[raw[words.end - 1]]) / many, n / (stops + 1), distinct / many, top / many,
            runs / np.maximum(n - 4, 1), n_lines / many, distinct_lines / np.maximum(n_lines, 1), np.log1p(longest)]
        out.append(np.column_stack(columns).astype(np.float32))
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)), np.float32)


@dataclass(frozen=True)
class Forest:
    """``feature`` and ``limit`` are trees x inner nodes (go right above the limit), ``leaf`` trees x leaves, as log-odds."""

    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        inner = self.feature.shape[1]
        rows, tree = np.arange(len(x))[:, None], np.arange(len(self.feature))[None]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range((inner + 1).bit_length() - 1):
            node = 2 * node + 1 + (x[rows, self.feature[tree, node]] > self.limit[tree, node])
        return 1 / (1 + np.exp(-(self.base + self.leaf[tree, node - inner].sum(1))))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
         smooth: float = 5.0) -> Forest:
    """Boosted trees for the logistic loss; without both classes in ``y`` a constant."""
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    inner = 2 ** depth - 1
    feature, limit, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, inner + 1))
    base = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Forest(feature, limit, leaf, base)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]).astype(np.float32)) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    odds = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-odds))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)  # place inside the level
        for level in range(depth):
            width, best = 2 ** level, np.full(2 ** level, 1e-6)
            cut_f, cut_b = np.zeros(width, np.int64), np.full(width, bins)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                key = node * (bins + 1) + binned[:, f]
                sums = [np.bincount(key, v, width * (bins + 1)).reshape(width, -1) for v in (g, h)]
                left_g, left_h = (np.cumsum(s, axis=1) for s in sums)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                gain = (left_g ** 2 / (left_h + smooth) + (all_g - left_g) ** 2 / (all_h - left_h + smooth)
                        - all_g ** 2 / (all_h + smooth))[:, :len(e)]
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                better = top > best
                best, cut_f, cut_b = np.where(better, top, best), np.where(better, f, cut_f), np.where(better, at, cut_b)
            for i in np.flatnonzero(cut_b < bins):
                feature[t, width - 1 + i], limit[t, width - 1 + i] = cut_f[i], edges[cut_f[i]][cut_b[i]]
            node = 2 * node + (binned[np.arange(len(y)), cut_f[node]] > cut_b[node])
        leaf[t] = rate * np.bincount(node, g, inner + 1) / (np.bincount(node, h, inner + 1) + smooth)
        odds += leaf[t][node]
    return Forest(feature, limit, leaf, base)


def fit(documents: DataFrame, labels: DataFrame, sample: int = 20_000, **options) -> Forest:
    """Trees grown on at most ``sample`` labelled documents (``labels``: ``doc_id``, ``label`` 0 or 1).

    The sample has the labels with the smallest hashes of their ids, and one row an
    id: of an id with several rows that with the smallest statistics. So no more
    than ``sample`` rows reach the driver. Null labels teach nothing; of an id that
    is labelled twice the smaller label counts.
    """
    chosen = labels.where("label IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = statistics(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), len(FEATURES)).cast(pa.list_(pa.float32()))],
                ["label", "doc_id", "x"])

    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.col("label").cast("int"), "text", "doc_id")
    key = rows.schema["doc_id"].dataType.simpleString()
    got = rows.mapInArrow(run, f"label int, doc_id {key}, x array<float>").groupBy("doc_id").agg(
        F.first("label").alias("label"), F.min("x").alias("x")).toPandas()
    x = np.array(got.x.tolist(), np.float32).reshape(len(got), len(FEATURES))
    order = np.lexsort((*x.T, got.label.to_numpy()))
    return grow(x[order], got.label.to_numpy(float)[order], **options)


def score(documents: DataFrame, forest: Forest) -> DataFrame:
    """``doc_id, score`` of every row of ``documents`` (``doc_id``, ``text``): the chance of label 1.

    Texts are read whole; null and empty texts are scored as statistics of zero.
    Rows keep their number and ids. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(forest.scores(statistics(b.column(1))))], ["doc_id", "score"])

    docs = documents.select("doc_id", "text")
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def keep_good(documents: DataFrame, forest: Forest, least: float = 0.5) -> DataFrame:
    """The rows of ``documents`` whose text scores ``least`` or more, all columns."""
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(forest.scores(statistics(b.column(at))) >= least))

    return documents.mapInArrow(run, documents.schema)


HELD_OUT: tuple[int, int] = (4, 2)


def held_out(key: Column) -> Column:
    return bucket_of(key, HELD_OUT[0]) == HELD_OUT[1]


def training_labels(spark, folder) -> DataFrame:
    return table(spark, folder, "labels", "doc_id", F.col("quality").alias("label")).where(~held_out(F.col("doc_id")))


@query("op9_quality_trees")
def op9_quality_trees(spark, folder):
    documents = table(spark, folder, "documents", "doc_id", "text")
    scored = score(documents, fit(documents, training_labels(spark, folder)))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))

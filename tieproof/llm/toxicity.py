"""Toxicity from confirmed toxic examples and unlabelled text.

A linear classifier over words, learnt by non-negative positive-unlabelled
risk: with the class prior p, loss l and score f, the risk is
``p E_pos[l(f)] + max(0, E_unl[l(-f)] - p E_pos[l(-f)])``. The second term
estimates the loss on the clean part of the unlabelled text; where a batch makes
it negative, the step goes back on it instead, so the model can't overfit it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieproof.llm.tables import bucket_of, query, table
from tieproof.llm.words import SPACE, Words, chunks, split

#: Words are runs of letters, digits and bytes outside ASCII.
BREAK = SPACE | np.array([c < 48 or 58 <= c < 65 or 91 <= c < 97 or 123 <= c < 128 for c in range(256)])


def _word_sets(words: Words) -> Iterator[np.ndarray]:
    h = words.hashes()
    for lo, hi in zip(words.first[:-1], words.first[1:]):
        yield np.unique(h[lo:hi])


@dataclass(frozen=True)
class Model:
    """``weight`` of the words whose hashes are ``word`` (sorted), by presence in a text, and a ``bias``."""

    word: np.ndarray
    weight: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = [np.zeros(0)]
        for lo, hi in chunks(texts):
            words = split(texts.slice(lo, hi - lo), space=BREAK)
            h, n = words.hashes(), hi - lo
            total = np.full(n, self.bias)
            if len(self.word) and len(h):
                at = np.minimum(np.searchsorted(self.word, h), len(self.word) - 1)
                hit = np.flatnonzero(self.word[at] == h)
                of = np.repeat(np.arange(n), np.diff(words.first))[hit]
                pairs = np.unique(of * len(self.word) + at[hit])
                total += np.bincount(pairs // len(self.word), self.weight[pairs % len(self.word)], n)
            out.append(1 / (1 + np.exp(-total)))
        return np.concatenate(out)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, most_words: int = 4096,
          least_z: float = 4.0, rounds: int = 80, batch: int = 256, rate: float = 0.1, shrink: float = 1e-5,
          seed: int = 7) -> Model:
    """nnPU training on sets of word hashes, with the sigmoid loss ``l(f) = 1 / (1 + exp(f))``.

    The vocabulary has the words that stand in at least three positive examples
    and, by ``least_z`` standard errors, more often in those than in unlabelled
    text; the ``most_words`` with the largest difference. Without positive or
    unlabelled examples the model is the prior.
    """
    prior = float(np.clip(prior, 1e-3, 0.999))
    if not positive or not unlabelled:
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))
    word, times = np.unique(np.concatenate(positive), return_counts=True)
    word, times = word[times >= 3], times[times >= 3]
    seen = np.zeros(len(word), np.int64)
    for s in unlabelled:
        seen += np.isin(word, s, assume_unique=True)
    p, u = times / len(positive), seen / len(unlabelled)
    both = (times + seen) / (len(positive) + len(unlabelled))
    z = (p - u) / np.sqrt(both * (1 - both) * (1 / len(positive) + 1 / len(unlabelled)) + 1e-12)
    chosen = np.lexsort((word, -z))[:most_words]
    vocabulary = np.sort(word[chosen][z[chosen] >= least_z])

    def matrix(sets):
        rows = [np.flatnonzero(np.isin(vocabulary, s, assume_unique=True)) for s in sets]
        return np.concatenate([[0], np.cumsum([len(r) for r in rows])]), np.concatenate(rows)

    p_first, p_word = matrix(positive)
    u_first, u_word = matrix(unlabelled)
    w = np.zeros(len(vocabulary) + 1)  # the last weight is the bias
    m, v, step = np.zeros_like(w), np.zeros_like(w), 0
    rng = np.random.default_rng(seed)

    def pick(first, words_, ids):
        n = first[ids + 1] - first[ids]
        at = np.repeat(first[ids] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return words_[at], np.repeat(np.arange(len(ids)), n)

    def forward(word_at, of, n):
        return np.bincount(of, w[word_at], n) + w[-1]

    def back(word_at, of, d):
        g = np.bincount(word_at, d[of], len(w))
        g[-1] += d.sum()
        return g

    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    batches = max(1, -(-len(unlabelled) // batch))
    for turn in range(rounds):
        for ids in np.array_split(rng.permutation(len(unlabelled)), batches):
            own = rng.integers(0, len(positive), min(batch, max(64, len(positive))))
            pw, pof = pick(p_first, p_word, own)
            uw, uof = pick(u_first, u_word, ids)
            sp, su = sigmoid(forward(pw, pof, len(own))), sigmoid(forward(uw, uof, len(ids)))
            clean = su.mean() - prior * sp.mean()
            slope_p, slope_u = sp * (1 - sp) / len(own), su * (1 - su) / len(ids)
            g_clean = back(uw, uof, slope_u) - prior * back(pw, pof, slope_p)
            g = -g_clean if clean < 0 else g_clean - prior * back(pw, pof, slope_p)
            g[:-1] += shrink * w[:-1]
            step += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= rate * (1 - turn / rounds) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Model(vocabulary, w[:-1].copy(), float(w[-1]))


def fit(documents: DataFrame, labels: DataFrame, unlabelled: Column, positives: int = 5000, others: int = 10_000,
        prior: float | None = None, **options) -> Model:
    """Learns from at most ``positives`` toxic documents and ``others`` documents whose labels are not looked at.

    ``labels`` has ``doc_id`` and ``label``; ``unlabelled`` says which documents may
    serve as unlabelled text. Both samples take the smallest hashes of the ids and
    one row an id: of an id with several rows that with the smallest set of words.
    The class prior is the share of label 1 among ``labels`` unless it is given.
    Null ids and labels teach nothing.
    """
    known = labels.where("label IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    if prior is None:
        prior = known.agg(F.avg(F.col("label").cast("double"))).first()[0] or 0.1
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    first = known.where("label = 1").orderBy(*order).limit(positives).select("doc_id", F.lit(True).alias("positive"))
    ids = documents.where(unlabelled & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    rest = ids.orderBy(*order).limit(others).select("doc_id", F.lit(False).alias("positive"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in chunks(b.column(1)):
                part = b.slice(lo, hi - lo)
                sets = list(_word_sets(split(part.column(1), space=BREAK)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([s.tobytes() for s in sets], pa.binary())], ["positive", "doc_id", "words"])

    rows = documents.select("doc_id", "text").join(F.broadcast(first.union(rest)), "doc_id").select("positive", "text", "doc_id")
    key = rows.schema["doc_id"].dataType.simpleString()
    got = rows.mapInArrow(run, f"positive boolean, doc_id {key}, words binary").groupBy("positive", "doc_id").agg(
        F.min("words").alias("words")).toPandas().sort_values(["positive", "words"])
    sets = lambda flag: [np.frombuffer(x, np.uint64) for x in got.words[got.positive == flag]]
    return train(sets(True), sets(False), float(prior), **options)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row of ``documents`` (``doc_id``, ``text``): the estimated chance of a toxic text.

    Texts are read whole; a null or empty text has the score of no words. Rows
    keep their number and ids. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(b.column(1)))], ["doc_id", "score"])

    docs = documents.select("doc_id", "text")
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def held_out(key: Column) -> Column:
    return bucket_of(key, 5) == 0


@query("op1_toxicity")
def op1_toxicity(spark, folder):
    documents = table(spark, folder, "documents", "doc_id", "text")
    labels = table(spark, folder, "labels", "doc_id", F.col("toxic").alias("label")).where(~held_out(F.col("doc_id")))
    scored = score(documents, fit(documents, labels, ~held_out(F.col("doc_id"))))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))

"""Words, tokens, secrets, trees and toxicity on small texts, against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tieproof.llm import quality, secrets, toxicity
from tieproof.llm.secrets import BASE, MORE, Rule, Scanner, find_secrets, mask_secrets, trigram_query
from tieproof.llm.token_count import PieceCounter, count_tokens, vocabulary
from tieproof.llm.words import shingles, split

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = ["", None, " ", "a", " a b ", "A b\tc\x0bd\x0ce\rf\n", "É\xa0é \x1f x", "one two three four", "x " * 50, "w" * 600_000 + " tail",
       "漢字 かな 漢字", "a b c d e a b c d e f"]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(ODD)] + [(None, "no id", "en", "s", 5), (3, "a", "en", "s", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, label string, n_chars long")


def test_words():
    for lo in (0, 3):
        texts = pa.array(ODD, pa.string()).slice(lo)
        w = split(texts)
        got = [[bytes(w.data[s:e]).decode() for s, e in zip(w.start[a:b], w.end[a:b])] for a, b in zip(w.first, w.first[1:])]
        assert got == [WORD.findall((t or "").translate(LOWER)) for t in ODD[lo:]]


def test_hash_of_a_word_is_that_of_its_text():
    r = random.Random(1)
    vocabulary = ["a", "b", "ab", "ba", "aé", "w" * 400_000] + ["".join(r.choices("abcdefgh", k=r.randint(1, 12))) for _ in range(500)]
    chosen = [r.choice(vocabulary) for _ in range(4000)]
    h = split(pa.array([" ".join(chosen)])).hashes()
    by_word = {}
    for word, x in zip(chosen, h.tolist()):
        assert by_word.setdefault(word, x) == x
    assert len(set(by_word.values())) == len(by_word)


def test_shingles():
    got = shingles(split(pa.array(ODD, pa.string())))
    for t, s in zip(ODD, got):
        w = WORD.findall((t or "").translate(LOWER))
        want = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        assert len(s) == len(want) and (np.diff(s.astype(object)) > 0).all()


# --- tokens -------------------------------------------------------------------


def test_tokens_as_the_library(spark, documents):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary())
    r = random.Random(3)
    odd = [t or "" for t in ODD] + ["".join(r.choices("ab eé \n\t▁</s><0x0A>漢ñaaaa  thinǵ😀", k=r.randrange(500))) for _ in range(400)]
    odd += ["ab" * 2000, " " * 999, "\x00", "<s></s><unk>", "the" * 900, "=-" * 300]
    assert PieceCounter(vocabulary()).counts(odd) == [len(x) for x in sp.encode(odd)]
    got = sorted((tuple(x) for x in count_tokens(documents, vocabulary(), 10).collect()), key=repr)
    rows = [(x.doc_id, x.text or "") for x in documents.collect()]
    want = [(i, len(t.encode()), len(sp.encode(t)), len(sp.encode(t)) > 10) for i, t in rows]
    assert got == sorted(want, key=repr)
    assert count_tokens(documents.limit(0), vocabulary()).count() == 0


# --- secrets ------------------------------------------------------------------

PARTS = ["password", "PassWD", "secret", "token", "api_key", "APIKEY", "\"", "'", " ", "  ", "=", ":", "*", "AKIA", "ABCDEF0123456789",
         "0123456789abcdef", "deadbeef", "é", "ſecret", "\n", "x", "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----",
         "ghp_" + "a1" * 20, "xoxb-1234567890ab", "eyJ" + "a" * 12 + "." + "b" * 12 + "." + "c" * 12, "abcdefghijkl"]


def plain_spans(text, rules=BASE + MORE):
    out = []
    for k, r in enumerate(rules):
        out += [(m.start(), k, m.end(), r.kind) for m in r.compiled().finditer(text or "") if len(m.group(r.group)) >= r.least]
    return [(s, e, kind) for s, _, e, kind in sorted(out)]


def test_secrets_as_plain_search():
    r = random.Random(5)
    texts = ["".join(r.choices(PARTS, k=r.randrange(12))) for _ in range(3000)] + [t or "" for t in ODD]
    assert Scanner(BASE + MORE).spans(pa.array(texts)) == [plain_spans(t) for t in texts]
    assert len({k for t in texts for _, _, k in plain_spans(t)}) == len(BASE + MORE)


def test_trigram_queries():
    assert trigram_query(Rule("k", "[0-9a-f]+")) is True
    assert trigram_query(Rule("k", "AKIA[A-Z]+")) == ("and", frozenset({b"aki", b"kia"}))
    assert trigram_query(Rule("k", "abc|xyz")) == ("or", frozenset({b"abc", b"xyz"}))
    assert trigram_query(Rule("k", "abc|x*")) is True
    assert trigram_query(Rule("k", "a[bc]d")) == ("or", frozenset({b"abd", b"acd"}))
    assert trigram_query(Rule("k", "ab(?:[A-Z]+ )?cd")) is True  # two letters on either side
    assert trigram_query(Rule("k", "abc(?:[A-Z]+ )?cd")) == b"abc"
    for text in ("abcd", "abXYZ cd"):
        rule = Rule("k", "ab(?:[A-Z]+ )?cd")
        assert Scanner([rule]).spans(pa.array([text])) == [[(0, len(text), "k")]]


def test_secret_tables(spark, documents):
    text = "token = abcdefghijklmnop AKIA" + "A" * 20 + " end"
    docs = documents.union(spark.createDataFrame([(90, text, "en", "s", len(text))], documents.schema))
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in find_secrets(docs).collect() if r.doc_id == 90}
    assert got == {90: plain_spans(text)}
    masked = mask_secrets(docs)
    assert masked.schema == docs.schema and masked.count() == docs.count()
    row = masked.where("doc_id = 90").first()
    assert row.text == "[assign] [access] end" and row.n_chars == len(row.text)
    assert masked.where("doc_id <> 90").exceptAll(docs.where("doc_id <> 90")).count() == 0
    assert find_secrets(docs.limit(0)).count() == 0 and mask_secrets(docs.limit(0)).count() == 0
    assert secrets.mask("abcdef", [(0, 3, "x"), (2, 5, "y")]) == "[x]f"


# --- quality ------------------------------------------------------------------


def test_trees_learn_a_rule_of_two_statistics():
    r = np.random.default_rng(1)
    x = r.normal(size=(4000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    forest = quality.grow(x[:3000], y[:3000], trees=40)
    assert ((forest.scores(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97
    walked = []
    for row in x[3000:3050]:  # the flat arrays, node by node
        total = forest.base
        for t in range(40):
            i = 0
            while i < forest.feature.shape[1]:
                i = 2 * i + 1 + int(row[forest.feature[t, i]] > forest.limit[t, i])
            total += forest.leaf[t, i - forest.feature.shape[1]]
        walked.append(1 / (1 + np.exp(-total)))
    assert np.allclose(walked, forest.scores(x[3000:3050]))
    assert quality.grow(x, np.ones(4000)).scores(x[:2]).min() > 0.9
    assert quality.grow(x[:0], y[:0]).scores(x[:2]).tolist() == [0.5, 0.5]


def test_statistics():
    x = quality.statistics(pa.array(ODD, pa.string()))
    assert x.shape == (len(ODD), len(quality.FEATURES)) and np.isfinite(x).all() and not x[0].any() and (x[0] == x[1]).all()
    f = quality.FEATURES.index
    assert x[8, f("distinct_words")] == np.float32(1 / 50) and x[8, f("top_word")] == 1
    one = quality.statistics(pa.array(["AB c!\nAB c!\n12"]))[0]
    assert one[f("upper")] == np.float32(4 / 14) and one[f("distinct_lines")] == np.float32(2 / 3) and one[f("digit")] == np.float32(2 / 14)


def test_quality_tables(spark, documents):
    labels = spark.createDataFrame([(0, 1), (0, 0), (5, None), (None, 1), (8, 0), (7, 1), (99, 1)], "doc_id long, label int")
    forest = quality.fit(documents, labels, sample=10)
    got = quality.score(documents, forest)
    assert got.count() == documents.count() and got.where("score between 0 and 1").count() == got.count()
    kept = quality.keep_good(documents, forest, 0.0)
    assert kept.schema == documents.schema and kept.exceptAll(documents).count() == 0 and kept.count() == documents.count()
    assert quality.score(documents.limit(0), quality.fit(documents, labels.limit(0))).count() == 0


@pytest.mark.parametrize("module, column, limit, least", [(quality, "quality", 0.7, 0.97), (toxicity, "toxic", 0.5, 0.95)])
def test_held_out_accuracy(spark, module, column, limit, least):
    folder = "/root/testdata/sf0.1"
    query = quality.op9_quality_trees if module is quality else toxicity.op1_toxicity
    got = query(spark, folder)
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = got.where("held_out").join(labels, "doc_id")
    assert held.select(F.avg((F.col("predicted") == F.col(column)).cast("double"))).first()[0] > least
    folds = got.select("doc_id", "held_out", "predicted", "score").collect()
    import zlib

    size, kept_out = (4, 2) if module is quality else (5, 0)
    for r in folds[:500]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % size == kept_out)
        assert r.predicted == int(r.score >= limit) and 0 <= r.score <= 1


@pytest.mark.parametrize("module", [quality, toxicity])
def test_samples_are_bounded_in_rows(spark, monkeypatch, module):
    """One id on most of the rows is one row of the sample."""
    rows = [(1, f"text number {i} of the one id") for i in range(500)] + [(i, f"another text {i}") for i in range(2, 40)]
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 0), (None, 1), (3, None)], "doc_id long, label int")
    seen = []
    if module is quality:
        real = quality.grow
        monkeypatch.setattr(quality, "grow", lambda x, y, **o: seen.append(len(x)) or real(x, y, **o))
        quality.fit(docs, labels, sample=11)
        assert seen[0] <= 11
    else:
        real = toxicity.train
        monkeypatch.setattr(toxicity, "train", lambda p, u, *a, **o: seen.append((len(p), len(u))) or real(p, u, *a, **o))
        toxicity.fit(docs, labels, F.lit(True), positives=11, others=7)
        assert seen[0][0] <= 11 and seen[0][1] == 7


# --- toxicity -----------------------------------------------------------------


def test_toxic_words_are_learnt_from_unlabelled_text():
    r = np.random.default_rng(2)
    bad, common = np.arange(1, 6, dtype=np.uint64), np.arange(100, 400, dtype=np.uint64)

    def doc(toxic):
        words = r.choice(common, 40, replace=False)
        return np.unique(np.concatenate([words, r.choice(bad, 2, replace=False)]) if toxic else words)

    positive = [doc(True) for _ in range(150)]
    unlabelled = [doc(i % 10 == 0) for i in range(1500)]
    model = toxicity.train(positive, unlabelled, 0.1)
    score = lambda s: model.bias + model.weight[np.isin(model.word, s)].sum()
    assert np.mean([score(doc(True)) > 0 for _ in range(300)]) > 0.95
    assert np.mean([score(doc(False)) > 0 for _ in range(300)]) < 0.02


def test_toxicity_tables(spark, documents):
    labels = spark.createDataFrame([(0, 1), (5, None), (None, 1), (8, 0), (8, 1)], "doc_id long, label int")
    model = toxicity.fit(documents, labels, F.lit(True))
    got = toxicity.score(documents, model)
    assert got.count() == documents.count() and got.where("score between 0 and 1").count() == got.count()
    nothing = toxicity.fit(documents.limit(0), labels.limit(0), F.lit(True))
    assert toxicity.score(documents, nothing).select("score").distinct().count() == 1
    assert toxicity.score(documents.limit(0), model).count() == 0
    texts = pa.array(ODD, pa.string())
    few = toxicity.Model(np.sort(split(pa.array(["tail four"])).hashes()), np.array([1.0, 2.0]), -1.0)
    alone = np.concatenate([few.scores(texts.slice(i, 1)) for i in range(len(ODD))])
    assert np.allclose(few.scores(texts), alone)

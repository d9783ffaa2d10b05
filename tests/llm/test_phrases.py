"""Collocations and order MinHash against plain Python."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tieproof.llm import collocations, order_minhash
from tieproof.llm.tables import QUERIES

FOLDER = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- collocations -----------------------------------------------------------------


def plain_counts(rows, longest=5):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i:i + size])] += 1
    return f, n


def plain_phrases(rows, least, top=2000):
    f, n = plain_counts(rows)
    big = {k: a for k, a in f.items() if a >= least}
    out = collections.defaultdict(list)
    inside = collections.defaultdict(int)
    for (lang, w), a in big.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                inside[lang, w[i:i + size]] = max(a, inside[lang, w[i:i + size]])
    for (lang, w), a in big.items():
        if len(w) > 1 and not 100 * inside[lang, w] >= 100 * a:
            cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    found = []
    for lang, rows_ in out.items():
        for rank, (s, a, w, left, right) in enumerate(sorted(rows_)[:top], 1):
            found.append((lang, rank, w.decode(), -a, left, right, n[lang], -s))
    return sorted(found)


def texts(rnd, n):
    words = ["The", "the", "old", "Ã©tÃ©", "Ärger", "ärger", "x y", "a-b", "1\x1c2", "日本", "q"]
    joins = [" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b", "; ", "! ", ": "]
    return ["".join(w + j for w, j in zip(rnd.choices(words, k=k), rnd.choices(joins, k=k))) for k in rnd.choices([0, 1, 2, 5, 30, 200], k=n)]


def docs_of(spark, rows):
    return spark.createDataFrame([(7, "zz", t, lang) for t, lang in rows], "f long, phrase string, text string, lang string")


def got_phrases(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("least", [1, 4, 25])
def test_phrases_of_random_texts(spark, least):
    rnd = random.Random(least)
    rows = [(t, rnd.choice(["en", "en", "de", None, "und"])) for t in texts(rnd, 120)]
    rows += [(None, "en"), ("", None), (None, None), ("one two", "xx")] + rows[:10]
    got = collocations.collocations(docs_of(spark, rows).repartition(3), least, local=500, texts=300)
    assert got_phrases(got) == plain_phrases(rows, least)


def test_a_language_that_holds_most_rows_and_a_very_long_text(spark):
    rnd = random.Random(9)
    rows = [(t, "en" if i % 10 else "de") for i, t in enumerate(texts(rnd, 300))]
    rows.append((" ".join(rnd.choices("a b c d e f".split(), k=60_000)) + ",", "en"))
    got = collocations.collocations(docs_of(spark, rows), 20, top=30)
    assert got_phrases(got) == plain_phrases(rows, 20, 30)


def test_small_bitmap_only_costs(spark):
    rnd = random.Random(10)
    rows = [(t, "en") for t in texts(rnd, 60)]
    got = collocations.collocations(docs_of(spark, rows), 3, most_bits=12)
    assert got_phrases(got) == plain_phrases(rows, 3)


def test_empty_tables(spark):
    assert collocations.collocations(docs_of(spark, []), 1).count() == 0
    assert collocations.collocations(docs_of(spark, [(None, None), ("", "en"), (" \t", "en"), (".,", "en")]), 1).count() == 0


def test_query_of_collocations(spark):
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert got_phrases(QUERIES["op12_collocations"](spark, FOLDER)) == plain_phrases(rows, 100)


def test_scores_beyond_64_bits(spark):
    big = 4 * 10 ** 12
    rows = [("en", "", 9 * big), ("en", "a", 3 * big + 1), ("en", "b", 2 * big + 7), ("en", "a b", big + 3)]
    got = collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, f long")).collect()
    assert [r.score for r in got] == [1000 * (big + 3) * 9 * big // ((3 * big + 1) * (2 * big + 7))]


def test_ties_go_to_the_shortest_left_part(spark):
    rows = [("en", "", 100), *[("en", w, 10) for w in ("a", "b", "c", "a b", "b c", "a b c")]]
    got = collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, f long"), absorb=101).collect()
    assert {r.phrase: (r.l, r.r, r.score) for r in got}["a b c"] == (10, 10, 10_000)
    kept = collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, f long"))
    assert [r.phrase for r in kept.collect()] == ["a b c"]


def test_summaries_keep_every_frequent_key():
    rng = np.random.default_rng(0)
    for least in (2, 7, 40):
        keys = np.concatenate([rng.integers(0, 1 << 40, 20_000), np.repeat(rng.integers(0, 1 << 40, 60), rng.integers(1, 90, 60))])
        rng.shuffle(keys)
        summary = collocations.Summary(len(keys) // least + 1)
        old, collocations.MERGE = collocations.MERGE, 64
        try:
            for part in np.array_split(keys.astype(np.uint64), 50):
                summary.add(*collocations.counted(part))
        finally:
            collocations.MERGE = old
        assert summary.taken < least
        counts = collections.Counter(keys.tolist())
        found = set(summary.survivors(least).tolist())
        assert found >= {k for k, c in counts.items() if c >= least}
        assert len(found) <= len(keys) // least + 1


def test_packed_numbers():
    for values in ([], [0], [127, 128, 0, 1 << 40, 5], list(range(300)), [(1 << 63) + 5]):
        a = np.array(values, np.uint64)
        assert collocations.unpacked(collocations.packed(a)).tolist() == a.tolist()


# --- order MinHash ------------------------------------------------------------------


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def of_long(value, seed=42):
    return signed(xxhash.xxh64_intdigest((value % (1 << 64)).to_bytes(8, "little"), seed=seed % (1 << 64)))


def of_int(value, seed):
    return signed(xxhash.xxh64_intdigest((value % (1 << 32)).to_bytes(4, "little"), seed=seed % (1 << 64)))


def of_text(value, seed=42):
    return signed(xxhash.xxh64_intdigest(value.encode(), seed=seed % (1 << 64)))


def chained(values, one, seed=42):
    for v in values:
        seed = one(v, seed)
    return seed


def plain_fingerprint(text, k=3, bins=64, size=2):
    """Tuples of the smallest numbered k-mers of each bin, by dictionaries."""
    tokens = re.findall(r"[^ \t\n\x0b\f\r]{1,4}", text or "")
    runs = [tokens[i:i + k] for i in range(len(tokens) - k + 1)] if len(tokens) >= k else [tokens] if tokens else []
    seen, by_bin = collections.Counter(), collections.defaultdict(list)
    for position, run in enumerate(runs):
        h = chained(run, of_text) >> 32
        g = of_int(seen[h], of_long(h)) >> 32
        seen[h] += 1
        by_bin[g >> 26].append((g, position))
    out = []
    for b, found in by_bin.items():
        least = sorted(sorted(found)[:size], key=lambda x: x[1])
        sig = chained([g % (1 << 32) for g, _ in least], of_long)
        out.append(((b + bins // 2) << 24) | sig % (1 << 24))
    return sorted(out)


def as_hex(entries):
    return "".join(f"{e:08x}" for e in entries)


def alike(a, b):
    bins = len({x >> 24 for x in a} | {x >> 24 for x in b})
    j = (len(set(a) & set(b)) / max(bins, 1)) ** 0.5
    return 2 * j / (1 + j) if bins else 1.0


def plain_rows(rows):
    """What the query returns, as a list: ids may repeat."""
    def key(r):
        h = of_text(r[1] or "")
        return (r[0] is not None, r[0] or 0, h, (r[1] or "").encode())
    ordered = sorted(rows, key=key)
    out = []
    for (doc, text), (_, after) in zip(ordered, [*ordered[1:], *ordered[:1]]):
        text, after = text or "", after or ""
        q = len(text) // 4
        edited = text[:len(text) - q] + after[:q]
        a, b, c = plain_fingerprint(text), plain_fingerprint(edited), plain_fingerprint(after)
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), as_hex(a), as_hex(b), round(alike(a, b), 9), round(alike(a, c), 9)))
    return sorted(out, key=str)


def got_rows(df):
    return sorted(((*tuple(r)[:5], round(r.near_edited, 9), round(r.near_next, 9)) for r in df.collect()), key=str)


def documents(spark, rows):
    return spark.createDataFrame([(d, "p", True, t) for d, t in rows], "doc_id long, p string, extra boolean, text string")


def test_fingerprints_of_odd_texts(spark):
    rnd = random.Random(3)
    rows = [(i, t) for i, t in enumerate(texts(rnd, 60))]
    rows += [(100, None), (101, ""), (102, " \n\t"), (103, "a"), (104, "ab \U0001f600\U0001f601 日本語日本語"),
             (105, "same same " * 400), (106, "x" * 3001), (-5, "first of all, first of all"), (200, "last")]
    rnd.shuffle(rows)
    assert got_rows(order_minhash.edited_fingerprints(documents(spark, rows).repartition(4))) == plain_rows(rows)


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e"), (1, "other text of one id"), (1, "a b c d e"), (None, "no id"), (None, "no id"), (None, "none either"), (2, "z")]
    rows += [(3, f"text {i} under one id") for i in range(60)]
    assert got_rows(order_minhash.edited_fingerprints(documents(spark, rows))) == plain_rows(rows)


def test_one_document_and_none(spark):
    one = [(4, "only one document here")]
    assert got_rows(order_minhash.edited_fingerprints(documents(spark, one))) == plain_rows(one)
    assert order_minhash.edited_fingerprints(documents(spark, [])).collect() == []


def test_many_ranges(spark):
    rows = [(i * 7 % 1009, f"doc {i} " * (i % 9)) for i in range(1009)]
    df = documents(spark, rows).select("doc_id", "text")
    got = {r.doc_id: r.after for r in order_minhash.with_next(df, "doc_id", "text", {"after": "text"}, block=4).collect()}
    ordered = sorted(rows)
    assert got == {d: t for (d, _), (_, t) in zip(ordered, [*ordered[1:], *ordered[:1]])}


def test_query_of_fingerprints(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = QUERIES["op13_order_minhash"](spark, FOLDER)
    assert got.columns == "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()
    got = got.toPandas()
    few = set(sorted(d for d, _ in rows)[::25])
    want = {r[0]: r for r in plain_rows(rows) if r[0] in few} if len(rows) < 1500 else {}
    assert len(got) == len(rows) and got.near_edited.between(0, 1).all() and got.near_edited[got.n_chars > 400].mean() > 0.6
    for r in got.itertuples(index=False):
        if r.doc_id in want:
            assert (r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9),
                    round(r.near_next, 9)) == want[r.doc_id]


def likeness_of(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    f = order_minhash.fingerprint
    return df.select(order_minhash.likeness(f(F.col("a")), f(F.col("b")))).first()[0]


def test_likeness_follows_edits_and_order(spark):
    rnd = random.Random(11)
    words = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9))) for _ in range(4000)]
    text = " ".join(words)
    few = list(words)
    for i in rnd.sample(range(4000), 40):
        few[i] = "changed"
    halves = [words[i:i + 2000] for i in (0, 2000)]
    shuffled = " ".join(itertools.chain(*reversed(halves)))
    assert likeness_of(spark, text, text) == 1
    assert likeness_of(spark, text, " ".join(few)) > 0.8
    assert likeness_of(spark, text, shuffled) < likeness_of(spark, text, " ".join(few)) - 0.02
    assert likeness_of(spark, text, " ".join(reversed(words))) < 0.3
    assert likeness_of(spark, text, " ".join(w[::-1] + "z" for w in words)) < 0.1

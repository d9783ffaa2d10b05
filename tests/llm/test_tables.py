"""Vectors, mixtures, conversations, leaks, near copies and the pipeline against plain Python."""

import collections
import hashlib
import json
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tieproof.llm import chat_format, decontaminate, mixture, near_copies, nearest
from tieproof.llm.components import components
from tieproof.llm.signature_tree import Links, Tree, bitmap, bits_for

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FOLDER = "/root/testdata/sf0.01"


def shingle_set(text, size=5):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


class Union:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


# --- vectors ------------------------------------------------------------------


def plain_nearest(rows, is_query, k):
    known = {}
    for i, v in rows:
        ok = i is not None and v is not None and None not in v and all(np.isfinite(v)) and any(v)
        if ok and (i not in known or v < known[i]):
            known[i] = v
    out = {}
    for q in filter(is_query, known):
        d = sorted((float(np.sqrt(((np.float64(known[q]) - np.float64(v)) ** 2).sum())), i) for i, v in known.items() if i != q)
        out[q] = [(i, s) for s, i in d[:k]]
    return out


def test_nearest_finds_ties_copies_and_leaves_bad_vectors_out(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in r.normal(size=6).astype(np.float32)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)] + [(rows[1][0], rows[1][1])]  # copies, a repeated row
    rows += [(2000, None), (2010, [0.0] * 6), (2020, [None] + [1.0] * 5), (2030, [float("nan")] * 6), (2040, [float("inf")] + [1.0] * 5),
             (None, [1.0] * 6)]
    df = spark.createDataFrame([(*x, "l") for x in rows], "vec_id long, embedding array<float>, rank string")
    got = collections.defaultdict(list)
    for q, rank, v, s in nearest.search(df, F.col("vec_id") % 10 == 0, 10, block=32, rows_per_task=300).orderBy("query_id", "rank").collect():
        got[q].append((v, s))
        assert len(got[q]) == rank
    want = plain_nearest(rows, lambda i: i % 10 == 0, 10)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))
    assert hits > 0.9
    for q in (0, 1000, 1050):  # the copies of a vector, by id
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (x[1], x[0])) and q not in {i for i, _ in found}


def test_nearest_does_not_depend_on_blocks_of_queries(spark):
    r = np.random.default_rng(3)
    # the last ones lie where cells hold too few, so they are compared with all
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([r.normal(size=(400, 5)), 40 * r.normal(size=(30, 5))]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one = nearest.search(df, F.col("vec_id") % 3 == 0, 10, rows_per_task=200).collect()
    many = nearest.search(df, F.col("vec_id") % 3 == 0, 10, rows_per_task=200, queries_per_task=20).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many)) and len(one) == 144 * 10


def test_nearest_with_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [50.0, 1.0]), (10, [-70.0, 3.0])], schema)
    got = {(r.query_id, r.vec_id, r["rank"]) for r in nearest.search(df, F.col("vec_id") % 10 == 0, 10).collect()}
    assert got == {(0, 1, 1), (0, 10, 2), (10, 0, 1), (10, 1, 2)}
    assert nearest.search(df.limit(0), F.lit(True)).count() == 0
    assert nearest.search(df.limit(1), F.lit(True)).count() == 0


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.1"])
def test_recall(spark, folder):
    got = collections.defaultdict(set)
    for r in nearest.op3_nearest_vectors(spark, folder).collect():
        got[r.query_id].add(r.vec_id)
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    hits = n = 0
    for q in np.flatnonzero(ids % 100 == 0):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        best = ids[np.lexsort((ids, d))[:10]]
        hits, n = hits + len(set(best.tolist()) & got[ids[q]]), n + 10
    assert hits / n >= 0.9


@pytest.mark.parametrize("kind", ["copies", "groups", "dense"])
def test_recall_beside_copies_and_dense_clusters(spark, kind):
    r = np.random.default_rng(5)
    base = r.normal(size=(1200, 24))
    more = {"copies": np.repeat(base[:1], 600, 0), "groups": np.repeat(base[:40], 15, 0),
            "dense": base[:1] + 0.001 * r.normal(size=(2400, 24))}[kind]
    x = np.concatenate([base, more]).astype(np.float32)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    got = collections.defaultdict(set)
    for q, v in nearest.search(df, F.col("vec_id") % 10 == 0, 10).select("query_id", "vec_id").collect():
        got[q].add(v)
    x, hits = x.astype(float), []
    for q in range(100, 1200, 10):  # vectors outside the copies and clusters
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hits.append(len(set(np.lexsort((np.arange(len(x)), d))[:10].tolist()) & got[q]) / 10)
    assert np.mean(hits) >= 0.9


# --- mixture ------------------------------------------------------------------


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, repeats=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while free and left > 1e-9:
        part = left / sum(weight[s] for s in free)
        for s in free:
            target[s] += part * weight[s]
        left = sum(max(0, target[s] - repeats * sizes[s]) for s in names)
        for s in names:
            if target[s] >= repeats * sizes[s]:
                target[s] = repeats * sizes[s]
                free.discard(s)
    return target


def check_mix(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, size string, taken int")
    got = mixture.mix(df, per_slot=7).collect()
    size = lambda t: len(WORD.findall(t or ""))
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    want = plain_targets(sizes)
    taken = collections.Counter()
    assert sorted(((r.doc_id, r.size) for r in got), key=repr) == sorted(((i, size(t)) for i, t, _ in rows), key=repr)
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size) and r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    longest = max((size(t) for _, t, _ in rows), default=0)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest + 1
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixture.mix(df, per_slot=50).collect()), key=repr)


def test_mixture(spark):
    r = random.Random(4)
    rows = [(i, " ".join(["w"] * r.choice([0, 1, 3, 20, 90])), r.choice(["a", "a", "a", "a", "b", "é", "Z", None])) for i in range(400)]
    check_mix(spark, rows + [(None, "a b", "a"), (None, "a b", "a"), (5, "x y z", "b"), (5, "x y z", "b"), (401, None, "only nulls")])
    check_mix(spark, [(1, "a b c", "a")])
    assert mixture.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
    none = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [x.taken for x in mixture.mix(none).collect()] == [0, 0]


def test_mixture_with_one_id_on_most_rows(spark):
    r = random.Random(9)
    rows = [(i, " ".join(["w"] * r.choice([1, 3, 20])), r.choice("ab")) for i in range(120)]
    rows += [(7, "w w w", "a")] * 150 + [(None, " ".join(["w"] * r.choice([2, 9])), "a") for _ in range(150)]
    check_mix(spark, rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted(map(tuple, mixture.mix(df).collect()), key=repr) == sorted(
        map(tuple, mixture.mix(df.repartition(5, "text"), per_slot=30).collect()), key=repr)


def test_mixed_documents(spark):
    rows = [(i, "w " * (i % 7), "ab"[i % 2], "t", 1) for i in range(60)] + [(None, "a b", "a", "t", 1)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target string, mix_size int")
    got = mixture.mixed_documents(df)
    assert got.columns == ["doc_id", "text", "source", "target", "mix_size", "mix_taken"]
    by_id = {r.doc_id: r.taken for r in mixture.mix(df).collect() if r.doc_id is not None}
    assert {r.doc_id: r.mix_taken for r in got.collect() if r.doc_id is not None} == {i: t for i, t in by_id.items() if t}


# --- conversations ------------------------------------------------------------


def test_template_reads_back():
    r = random.Random(6)
    bits = [*chat_format.CONTROL, chat_format.ESCAPE, "<", "[", "/INST]", "␛␛", "\n", "\\n", '"', " ", "x", "é", "[INST] user\n", "SYS>>", "<<s>"]
    for _ in range(3000):
        turns = [(r.choice(["user", "assistant", "system", "to\nol", '"q"', "", "[INST]", "</s>"]), "".join(r.choices(bits, k=r.randrange(6))))
                 for _ in range(r.randrange(6))]
        text, spans = chat_format.write(turns)
        assert chat_format.read(text) == turns
        assert [chat_format.unescape(text[s:e]) for s, e in spans] == [t for role, t in turns if role == "assistant"]
        for _, t in turns:
            assert chat_format.unescape(chat_format.escape(t)) == t
            assert not any(c in chat_format.escape(t) for c in chat_format.CONTROL)


def test_layouts(spark):
    user, assistant = ("user", "q"), ("assistant", "a")
    cases = [
        ({"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]}, "messages", [user, assistant]),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "conversations", [user, assistant]),
        ({"system": "s", "conversations": [{"from": "human", "value": "q"}]}, "conversations", [("system", "s"), user]),
        ({"completion": "a", "prompt": "q"}, "prompt", [user, assistant]),
        ({"prompt": "q", "response": "a"}, "response", [user, assistant]),
        ({"instruction": "q", "input": "more", "output": "a"}, "instruction", [("user", "q\n\nmore"), assistant]),
        ({"instruction": "q", "output": None}, "instruction", [user, ("assistant", "")]),
        ({"instruction": "q", "output": {"b": [1]}}, None, None),
        ({"messages": []}, "messages", []),
        ({"prompt": "q"}, None, None),
        ([1], None, None),
    ]
    rows = [(i, json.dumps(c[0])) for i, c in enumerate(cases)] + [(50, None), (51, ""), (52, "{"), (None, json.dumps(cases[3][0]))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, record string, formatted string")
    got = chat_format.format_records(df).collect()
    assert len(got) == len(rows)
    for r in got:
        _, name, turns = cases[r.conv_id] if r.conv_id is not None and r.conv_id < 50 else cases[3] if r.conv_id is None else (0, None, None)
        assert r.layout == name and (r.formatted is None) == (turns is None)
        if turns is not None:
            assert chat_format.read(r.formatted) == turns
    assert chat_format.digests(chat_format.format_records(df)).where("n_turns is null").count() == 6


def test_conversation_rows(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 1, "assistant", None), (2, 0, None, "x"), (2, 0, None, "x"), (2, None, "tool", "t"),
            (3, 0, "system", "s"), (3, 1, "user", "q"), (3, 2, "assistant", "</s>" * 9), (None, 4, "user", "[INST]"),
            *((4, k, "ua"[k % 2] == "u" and "user" or "assistant", f"t{k}") for k in range(9)), (5, 0, "user", "w " * 100_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, record string")
    layouts = {r.conv_id: r.layout for r in chat_format.format_records(chat_format.records_of(df)).collect()}
    assert layouts == {1: "prompt", 2: "messages", 3: "instruction", None: "messages", 4: "conversations", 5: "messages"}
    assert same_conversations(chat_format.conversation_digests(df), rows) == 6
    assert chat_format.records_of(df.limit(0)).count() == 0
    assert chat_format.conversation_digests(df.limit(0)).count() == 0


def same_conversations(digests, rows):
    got = digests.collect()
    for r in got:
        own = sorted((-1 if t is None else t, role or "", x or "") for c, t, role, x in rows if c == r.conv_id)
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{x}\n" for _, a, x in own).encode()).hexdigest()
        loss = "".join(x for _, a, x in own if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return len(got)


@pytest.mark.parametrize(("hot_id", "turn"), [(3, None), (3, 7), (3, "own"), (None, "own")])
def test_a_conversation_with_most_rows(spark, hot_id, turn):
    """One conversation, its rows in many turns or all in one, is formatted by several tasks in small records."""
    r = random.Random(4)
    rows = [(hot_id, k if turn == "own" else turn, r.choice(["user", "assistant", "r" * 70 + "ab"[k % 2]]), f"{r.randrange(900)} </s> é")
            for k in range(3000)]
    rows += [(k, 0, "user", "q") for k in range(100, 160)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert [r.conv_id for r in chat_format.hot_ids(df).collect()] == [hot_id]
    records = chat_format.records_of(df, True, most_turns=20, most_chars=150)
    hot = records.where(F.col("conv_id").eqNullSafe(F.lit(hot_id))).select(F.shiftright("part", 33).alias("task"), "record").collect()
    assert len({h.task for h in hot}) > 2
    assert max(len(chat_format.Layouts().turns(h.record)[1]) for h in hot) <= 20
    assert same_conversations(chat_format.conversation_digests(df, 20, 150), rows) == 61


# --- leaks --------------------------------------------------------------------


def test_leaks(spark):
    r = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    item = lambda n: " ".join(r.choices(words, k=n)).capitalize() + ". " + " ".join(r.choices(words, k=5)) + "."
    items = [(i, item(r.randrange(8, 50))) for i in range(150)] + [(900, None), (901, ""), (None, "w1 w2"), (902, "single")]
    docs = []
    for k in range(200):
        body = r.choices(words, k=r.randrange(0, 700))
        leak = r.choice(items[:150]) if k % 4 == 0 else None
        if leak:
            body.insert(r.randrange(len(body) + 1), leak[1].upper() if k % 8 else leak[1])
        docs.append((k, " ".join(body), leak and leak[0]))
    docs += [(500, None, None), (501, "", None), (502, " ".join(i[1].partition(".")[0] for i in items[:3]), None)]
    df = spark.createDataFrame([(i, t, "x", 1.0) for i, t, _ in docs], "doc_id long, text string, item_id string, score double")
    known = spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, doc_id string")
    got = decontaminate.find_leaks(df, known).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, leak) for i, _, leak in docs if leak is not None}
    kept = decontaminate.keep_clean(df, known)
    assert kept.schema == df.schema and {r.doc_id for r in kept.collect()} == {i for i, _, leak in docs if leak is None}
    assert decontaminate.find_leaks(df, known.limit(0)).count() == 0 and decontaminate.keep_clean(df, known.limit(0)).count() == len(docs)
    assert decontaminate.find_leaks(df.limit(0), known).count() == 0


def test_leaks_with_one_word_changed():
    """Every word of an item in turn, and pairs of them; a question whose answer is another stays no leak."""
    items = pq.read_table("/root/testdata/sf0.1/benchmark.parquet")["text"].to_pylist()
    index = decontaminate.Index(list(range(len(items))), items, decontaminate.Terms())
    split = lambda t: decontaminate.split(pa.array(t), space=decontaminate.BREAK)
    r = random.Random(3)
    texts, want = [], []
    for i, text in enumerate(items):
        words = text.split()
        for at in [*((k,) for k in range(len(words))), tuple(r.sample(range(len(words)), 2))]:
            if len(at) * 5 <= len(words):
                changed = ["qqxx" + "." * w.endswith(".") if k in at else w for k, w in enumerate(words)]
                texts.append(" ".join(["zzq"] * r.randrange(90) + changed + ["zzq"] * r.randrange(90)))
                want.append(i)
    got = {(t, index.ids[i]) for t, i, *_ in index.leaks(split(texts))}
    assert [(i, texts[t]) for t, i in enumerate(want) if (t, i) not in got] == []
    for i, text in zip(index.ids, index.words):
        cut = index.cut[index.ids.index(i)]
        if len(text) - cut > 3:
            asked = " ".join(re.findall(r"[0-9A-Za-z\x80-\uffff]+", items[i])[:cut] + ["qqxx"] * (len(text) - cut))
            assert not index.leaks(split([asked])), asked


def test_retrieval_is_the_plain_score():
    """All passages that reach the threshold are retrieved, before overlap is asked for."""
    r = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    items = [" ".join(r.choices(words, k=r.randrange(3, 20))) for _ in range(40)]
    terms = decontaminate.Terms(threshold=0.5, overlap=0.0, stride=8)
    index = decontaminate.Index(list(range(40)), items, terms)
    texts = [" ".join(r.choices(words, k=r.randrange(0, 120))) for _ in range(60)]
    split = lambda t: decontaminate.split(pa.array(t), space=decontaminate.BREAK)
    got = {(t, index.ids[i]): s for t, i, s, *_ in index.leaks(split(texts))}
    reach = -(-index.width // 8) * 8
    want = {}
    for t, text in enumerate(texts):
        h = split([text]).hashes()
        for at in range(0, len(h), 8):
            own = np.flatnonzero(np.isin(index.vocabulary, h[at:at + reach]))
            for i, s in enumerate(index.impact[own].astype(float).sum(0)[:40]):
                if s >= 0.5:
                    want[t, index.ids[i]] = max(s, want.get((t, index.ids[i]), 0))
    assert len(want) > 50 and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-5 for k in want)


def test_index_follows_the_postings():
    r = random.Random(2)
    items = [" ".join(f"w{r.randrange(90_000)}" for _ in range(30)) for _ in range(3000)]
    split = lambda t: decontaminate.split(pa.array(t), space=decontaminate.BREAK)
    tracemalloc.start()
    index = decontaminate.Index(list(range(3000)), items, decontaminate.Terms())
    got = {(t, index.ids[i]) for t, i, *_ in index.leaks(split([f"w1 {t} w2" for t in items[::10]]))}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got >= {(k, 10 * k) for k in range(300)} and peak < 300e6  # a table of words x items has about 700 MB


def test_leaks_do_not_depend_on_slices(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    texts = [r.text for r in rows.orderBy("item_id").collect()][:40]
    split = decontaminate.split(pa.array([f"{a} x {b}" for a, b in zip(texts, texts[1:])]), space=decontaminate.BREAK)

    def found(slices):
        out = {}
        for ids, items, known in slices:
            index = decontaminate.Index(ids, items, decontaminate.Terms(), known)
            out |= {(t, index.ids[i]): v for t, i, *v in index.leaks(split)}
        return out

    whole = found(decontaminate.known_slices(rows))
    for bounds in ({"most": 7}, {"size": 3000}):
        slices = list(decontaminate.known_slices(rows, **bounds))
        assert len(slices) > 5 and all(len(i) <= 7 or sum(len(t.encode()) for t in x) <= 3000 for i, x, _ in slices)
        got = found(slices)
        assert set(got) == set(whole) and all(got[k] == pytest.approx(whole[k]) for k in got)


def test_leaks_over_many_slices(spark, monkeypatch):
    """``find_leaks`` and ``keep_clean`` take slice after slice; the driver holds two of them."""
    items = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").limit(60)
    texts = {r.item_id: r.text for r in items.collect()}
    docs = spark.createDataFrame(
        [(i, f"before {t} after" if i % 3 else "nothing of it", "x") for i, t in texts.items()] + [(None, None, "y")],
        "doc_id long, text string, item_id string")
    whole = sorted(map(tuple, decontaminate.find_leaks(docs, items).drop("score").collect()))
    clean = sorted((str(tuple(r)) for r in decontaminate.keep_clean(docs, items).collect()))
    real, cut = decontaminate.item_slices, []

    def small(rows, **_):
        for part in real(rows, most=13):
            cut.append(part)
            yield part

    monkeypatch.setattr(decontaminate, "item_slices", small)
    assert sorted(map(tuple, decontaminate.find_leaks(docs, items).drop("score").collect())) == whole and len(cut) == 5
    assert sorted((str(tuple(r)) for r in decontaminate.keep_clean(docs, items).collect())) == clean
    assert {i for i, *_ in whole} == {i for i in texts if i % 3}
    taken = []
    monkeypatch.setattr(decontaminate, "item_slices", lambda rows, **_: (taken.append(1) or p for p in real(rows, most=5)))
    next(decontaminate.known_slices(items))
    assert len(taken) == 2


def test_leaks_of_the_tables(spark):
    got = {(r.doc_id, r.item_id) for r in decontaminate.op10_decontamination(spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    assert got == {(d.doc_id, i.item_id) for d in docs for i in items if i.text.lower() in d.text.lower()} and len(got) > 10


# --- near copies --------------------------------------------------------------


def plain_components(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    union = Union(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                union.join(a, b)
    least = {}
    for k, (i, _) in enumerate(rows):
        root = union.find(k)
        least[root] = min((v for v in (i, least.get(root)) if v is not None), default=None)
    return sorted(((i, len(sets[k][1]), least[union.find(k)]) for k, (i, _) in enumerate(rows)), key=repr)


def edited(r, words, share):
    return [r.choice("abcdefgh") if r.random() < share else w for w in words]


@pytest.mark.parametrize("block", [4, 256])
def test_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(near_copies.links_in_groups, "__defaults__", (block,))
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = r.choices(vocabulary, k=60)
    texts = [None, "", " ", "one", "One", "one two", "a b c d e", "A b c d e"]
    for k in range(25):
        base = r.choices(vocabulary, k=r.randrange(6, 150))
        texts += [" ".join(edited(r, base, r.choice([0, 0.01, 0.02, 0.03, 0.04]))) for _ in range(30 if k == 0 else r.randrange(1, 6))]
    texts += [" ".join(r.choices(vocabulary, k=r.randrange(40)) + passage) for _ in range(40)]  # a passage that many share
    r.shuffle(texts)
    rows = [(i * 3 + 7, t) for i, t in enumerate(texts)] + [(None, "one two"), (7, texts[0])]
    df = spark.createDataFrame([(*x, 1, "z") for x in rows], "doc_id long, text string, n long, cls string")
    got = near_copies.near_copy_components(df)
    want = plain_components(rows)
    assert sorted((tuple(x) for x in got.collect()), key=repr) == want
    kept = near_copies.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(x.doc_id for x in kept.collect() if x.doc_id is not None) == sorted({i for i, _, c in want if i == c and i is not None})
    assert kept.where("doc_id is null").count() == 1
    assert near_copies.near_copy_components(df.limit(0)).count() == 0 and near_copies.keep_one(df.limit(0)).count() == 0


def test_links_through_rows_without_an_id(spark):
    words = [f"w{i}" for i in range(200)]
    share = lambda x, y: len(x & y) / len(x | y)
    a, b, c = " ".join(words), " ".join(words[20:] + ["b1"]), " ".join(words[45:] + ["b1", "c1"])
    assert share(shingle_set(a), shingle_set(b)) >= 0.8 <= share(shingle_set(b), shingle_set(c)) and share(shingle_set(a), shingle_set(c)) < 0.8
    rows = [(1, a), (None, b), (3, c), (5, "quite another text of some words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, near_copies.near_copy_components(df).collect()), key=repr) == plain_components(rows)
    assert sorted(x.doc_id or 0 for x in near_copies.keep_one(df).collect()) == [0, 1, 5]
    lone = [(None, a), (None, b), (None, "one two")]
    got = near_copies.near_copy_components(spark.createDataFrame(lone, "doc_id long, text string")).collect()
    assert [r.component_id for r in got] == [None] * 3


def test_unrelated_texts_of_one_id_stay(spark):
    rows = [(1, "first text of the id one", "a"), (1, "second and quite other text here", "b"), (1, "first text of the id one", "c"),
            (2, "second and quite other text here", "d"), (3, "", "e"), (3, " ", "f"), (None, "first text of the id one", "g")]
    kept = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string, row string"))
    got = sorted((r.doc_id or 0, r.text) for r in kept.collect())
    assert got == [(0, rows[0][1]), (1, rows[0][1]), (1, rows[1][1]), (3, ""), (3, " ")]
    assert kept.columns == ["doc_id", "text", "row"]


def test_near_copies_of_the_tables(spark):
    rows = [(x.doc_id, x.text) for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = near_copies.op8_near_copies(spark, "/root/testdata/sf0.001").collect()
    assert sorted((tuple(x) for x in got), key=repr) == plain_components(rows)


def test_signature_tree_is_exact():
    r = np.random.default_rng(3)
    for n in (2, 9, 70):
        bases = [np.unique(r.integers(0, 1 << 63, r.integers(1, 60), dtype=np.uint64)) for _ in range(n // 3 + 1)]
        sets = [np.unique(np.concatenate([b[r.random(len(b)) > 0.06], r.integers(0, 1 << 63, 2, dtype=np.uint64)]))
                for b in (bases[r.integers(len(bases))] for _ in range(n))]
        size = np.array([len(s) for s in sets])
        maps = np.array([bitmap(s, bits_for(int(np.median(size)))) for s in sets])
        alike = lambda i, j: 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
        linked = Links(range(n))
        Tree(size, maps).walk(linked, alike)
        union = Union(range(n))
        for i in range(n):
            for j in range(i):
                if alike(i, j):
                    union.join(i, j)
        assert [linked.find(i) for i in range(n)] == [union.find(i) for i in range(n)]


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(300, 360)] + [(9, 9)]
    edges += [(r.randrange(1000, 1200), r.randrange(1000, 1200)) for _ in range(90)]
    union = Union({x for e in edges for x in e})
    for e in edges:
        union.join(*e)
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: union.find(i) for i in union.up if i != 9}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- pipeline -----------------------------------------------------------------


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [i.text.lower() for i in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns, before = docs.columns, {d.doc_id: d for d in docs.collect()}
    whole = dict(before)
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(docs.collect(), docs.schema) if name != "quality" else docs
        out = stage(spark, docs, FOLDER).collect()
        after = {d.doc_id: d for d in out}
        assert len(after) == len(out) and set(after) <= set(before)
        if name != "mixture":
            assert list(out[0].asDict()) == columns
        if name == "quality":
            labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
            assert np.mean([(x.doc_id in after) == (x.quality == 1) for x in labels]) > 0.97
        elif name == "near_copies":
            want = plain_components([(i, d.text) for i, d in before.items()])
            assert set(after) == {i for i, _, c in want if i == c}
        elif name == "decontamination":
            assert set(after) == {i for i, d in before.items() if not any(x in d.text.lower() for x in items)}
        elif name == "secrets":
            assert set(after) == set(before)
            for i, d in after.items():
                assert d.n_chars == len(d.text) or d.text == before[i].text
                assert not re.search(r"AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}", d.text)
        else:
            assert all(d.mix_taken in (d.mix_size, 2 * d.mix_size) for d in out)
            sizes = collections.Counter()
            for d in before.values():
                sizes[d.source] += len(WORD.findall(d.text))
            taken, want = collections.Counter(), plain_targets(sizes)
            for d in out:
                taken[d.source] += d.mix_taken
            longest = max(len(WORD.findall(d.text)) for d in before.values())
            assert all(abs(taken[s] - want[s]) <= longest for s in sizes)
        docs, before = spark.createDataFrame(out, spark.createDataFrame(out[:1]).schema if name == "mixture" else docs.schema), after
    assert {d.doc_id for d in corpus_pipeline.run(spark, FOLDER).collect()} == set(before) < set(whole)

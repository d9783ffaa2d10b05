import itertools
import random

import pytest
from pyspark.sql import functions as F

from tieproof.operators import graph, joins, process_tree


def edges(spark, rows):
    return spark.createDataFrame(rows, "company string, person string")


@pytest.mark.parametrize("start", [3, 512])
def test_pairs_of_companies_of_any_size(spark, start):
    rnd = random.Random(3)
    rows = [("hot", f"P{i}") for i in range(70)] * 2 + [(f"C{rnd.randrange(12)}", f"P{rnd.randrange(30)}") for _ in range(60)]
    rows += [("C1", "(unspecified)"), ("C1", " ")]
    e = edges(spark, rows)
    teams = {}
    for c, p in rows:
        if p.strip() and p != "(unspecified)":
            teams.setdefault(c, set()).add(p)
    want = {}
    for c, people in teams.items():
        for a, b in itertools.combinations(sorted(people), 2):
            want[a, b] = want.get((a, b), 0) + 1
    listed = graph.shared_companies(e).collect()
    assert {(r["company"], r["person"]) for r in listed} == {(c, p) for c, ps in teams.items() for p in ps if len(ps) > 1}
    assert all(r["members"] == len(teams[r["company"]]) for r in listed)
    asked = spark.createDataFrame([p for i, p in enumerate(sorted(want)) if i % 7 == 0], "source string, target string")
    got = {(r["source"], r["target"]): r["weight"] for r in graph.pair_weight(e, asked).collect()}
    assert got == {p: want[p] for i, p in enumerate(sorted(want)) if i % 7 == 0}
    none = spark.createDataFrame([("P0", "nobody")], "source string, target string")
    assert [r["weight"] for r in graph.pair_weight(e, none).collect()] == [0]
    top = [tuple(r) for r in graph.top_pairs(e, 9, start).collect()]
    assert top == [(*k, w) for k, w in sorted(want.items(), key=lambda x: (-x[1], x[0]))[:9]]


def test_repeated_pairs_are_whole_and_labelled(spark):
    """Pairs that share several companies, also those in which nobody is a company's first member."""
    rnd = random.Random(4)
    rows = [("hot", f"P{i:02}") for i in range(60)] * 2 + [(f"C{rnd.randrange(20)}", f"P{rnd.randrange(60):02}") for _ in range(150)]
    rows += [(c, p) for c in ("X1", "X2", "X3") for p in ("A first", "Y", "Z")] + [("X1", " "), ("X1", "unknown")]
    teams = {}
    for c, p in rows:
        if p.strip() and p != "unknown":
            teams.setdefault(c, set()).add(p)
    want = {}
    for c, people in sorted(teams.items()):
        for pair in itertools.combinations(sorted(people), 2):
            want.setdefault(pair, []).append(c)
    got = {(r["source"], r["target"]): (r["weight"], r["companies"]) for r in graph.repeated_pairs(edges(spark, rows)).collect()}
    assert got == {k: (len(v), "; ".join(v)) for k, v in want.items() if len(v) > 1}
    assert got["Y", "Z"] == (3, "X1; X2; X3")


@pytest.mark.parametrize("few", [0, 2, 9, 32, 100])
def test_pairs_meet_the_same_in_small_and_large_companies(spark, few):
    rnd = random.Random(11)
    rows = [(f"H{h}", f"P{i:02}") for h in range(3) for i in range(h * 5, 40)] * 2
    rows += [(f"C{rnd.randrange(25):02}", f"P{rnd.randrange(45):02}") for _ in range(120)]
    teams, want = {}, {}
    for c, p in rows:
        teams.setdefault(c, set()).add(p)
    for c, people in sorted(teams.items()):
        for pair in itertools.combinations(sorted(people), 2):
            want.setdefault(pair, []).append(c)
    e = edges(spark, rows)
    got = {(r["source"], r["target"]): (r["weight"], r["companies"]) for r in graph.repeated_pairs(e, few).collect()}
    assert got == {k: (len(v), "; ".join(v)) for k, v in want.items() if len(v) > 1}
    ranked = sorted(want.items(), key=lambda x: (-len(x[1]), x[0]))
    assert [tuple(r) for r in graph.top_pairs(e, 25, 6, few).collect()] == [(*k, len(v)) for k, v in ranked[:25]]


def test_pairs_of_small_companies_are_shuffled_once(spark):
    """They meet in one join and are counted in one grouping; companies are looked up only where some are large."""
    rows = [(f"C{i % 7}", f"P{i % 5}") for i in range(35)]
    plan = graph.repeated_pairs(edges(spark, rows))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and plan.count("Aggregate") == 1


@pytest.mark.parametrize("k", [1, 4, 30, 500])
@pytest.mark.parametrize("shape", ["ring", "alone", "twice", "none", "hot"])
def test_top_pairs_where_degrees_are_tied(spark, shape, k):
    rows = {
        "ring": [(f"C{i:02}", f"P{(i + d) % 30:02}") for i in range(30) for d in (0, 1, 2)],
        "alone": [(f"C{i:02}", f"P{i:02}{d}") for i in range(12) for d in "ab"],
        "twice": [(f"C{i:02}{d}", f"P{(i + x) % 10:02}") for i in range(10) for d in "ab" for x in (0, 1)],
        "none": [(f"C{i}", f"P{i}") for i in range(5)],
        "hot": [("hot", f"P{i:03}") for i in range(200)] + [("C1", "P150"), ("C1", "P151")],
    }[shape]
    teams, want = {}, {}
    for c, p in rows:
        teams.setdefault(c, set()).add(p)
    for people in teams.values():
        for pair in itertools.combinations(sorted(people), 2):
            want[pair] = want.get(pair, 0) + 1
    got = [tuple(r) for r in graph.top_pairs(edges(spark, rows), k, 5).collect()]
    assert got == [(*p, w) for p, w in sorted(want.items(), key=lambda x: (-x[1], x[0]))[:k]]


def test_expansion_keeps_its_budget(spark):
    rows = [("c1", "a"), *[("c1", f"b{i}") for i in range(6)], ("c2", "a"), ("c2", "b5"), ("c3", "b4"), ("c3", "d"), ("c4", "b5"), ("c4", "d"),
            ("c4", "e"), ("c5", "d"), ("c5", "b1"), ("c5", "f"), ("c5", " ")]
    seeds = spark.createDataFrame([("a",), ("a",), (None,), ("unknown",)], "person string")
    got = {r["person"]: (r["hop"], r["rank"], r["via"]) for r in graph.expand(edges(spark, rows), seeds, 3, 2).collect()}
    # b5 shares two companies with a, then names decide; d is met through c4 alone, as b4 was cut
    assert got == {"a": (0, 1, None), "b5": (1, 1, "c1"), "b0": (1, 2, "c1"), "d": (2, 1, "c4"), "e": (2, 2, "c4"),
                   "b1": (3, 1, "c5"), "b4": (3, 2, "c3")}
    free = {r["person"]: r["hop"] for r in graph.expand(edges(spark, rows), seeds, 9).collect()}
    assert free == {"a": 0, **{f"b{i}": 1 for i in range(6)}, "d": 2, "e": 2, "f": 2}


def test_graph_files_take_vertices_and_members_at_hand(spark):
    """Written vertices and members serve all files of the graph, which then read no edges for them again."""
    rows = [("c1", "a"), ("c1", "b"), ("c2", "a"), ("c2", "b"), ("c3", "b")]
    e = edges(spark, rows).withColumns({"school": F.concat(F.lit("s of "), "company"), "role": F.lit("r")})
    vertices, shared = graph.written(graph.people(e, F.col("company"))), graph.written(graph.shared_companies(e))
    got = {tuple(r) for r in graph.person_company(e, F.col("company"), vertices).select("source", "target", "school").collect()}
    assert got == {(f"P:{p}", f"C:{c}", "s of c1") for c, p in rows}
    pairs = graph.person_person(e.where("false"), shared).collect()
    assert [tuple(r) for r in pairs] == [("P:a", "P:b", "shared_company", 2, "c1; c2")]


def test_expansion_counts_repeated_edges_once(spark):
    rows = [("c1", "a"), ("c1", "b"), ("c1", "b"), ("c1", "b"), ("c1", "d"), ("c2", "a"), ("c2", "d")]
    seeds = spark.createDataFrame([("a",)], "person string")
    got = sorted(tuple(r) for r in graph.expand(edges(spark, rows * 2), seeds, 1, 1).collect())
    assert got == [("a", 0, 1, None), ("d", 1, 1, "c1")]


def test_expansion_shuffles_no_edges_for_a_few_people(spark):
    """What a hop found is small and known to be, so the hop's plan sends it to the edges; before, both sides were shuffled."""
    made = []
    real = graph.written
    graph.written = lambda df: made.append(df._jdf.queryExecution().executedPlan().toString()) or real(df)
    try:
        e = edges(spark, [(f"c{i % 50}", f"p{i % 70}") for i in range(400)])
        graph.expand(e, spark.createDataFrame([("p1",)], "person string"), 2, 3).count()
    finally:
        graph.written = real
    assert not any("SortMergeJoin" in plan for plan in made) and "Exchange" not in made[0]


def test_expansion_is_bounded_and_visits_once(spark):
    e = edges(spark, [("c1", "a"), ("c1", "b"), ("c2", "b"), ("c2", "c"), ("c3", "c"), ("c3", "d"), ("c4", "z")])
    seeds = spark.createDataFrame([("a",)], "person string")
    got = lambda h: {r["person"]: r["hop"] for r in graph.expand(e, seeds, h).collect()}
    assert got(1) == {"a": 0, "b": 1}
    assert got(5) == {"a": 0, "b": 1, "c": 2, "d": 3}


def procs(spark, rows):
    return spark.createDataFrame(rows, "pid long, ppid long, name string")


def test_orphans(spark):
    p = procs(spark, [
        (1, 0, "python.exe"), (10, 1, "chrome.exe"), (11, 10, "chrome.exe"),      # live parent: spared
        (20, 999, "chrome.exe"), (21, 20, "chrome.exe"), (22, 21, "chrome.exe"),  # orphan root and tree
        (30, 22, "python.exe"), (31, 30, "chrome.exe"),                           # behind another program
        (40, 41, "chrome.exe"), (41, 40, "chrome.exe"),                           # a cycle has no root
    ])
    assert {(r["pid"], r["root"]) for r in process_tree.orphans(p, "chrome.exe").collect()} == {(20, 20), (21, 20), (22, 20)}


def test_long_chain_and_count(spark):
    p = procs(spark, [(i, i - 1, "chrome.exe") for i in range(1, 301)] + [(500, 42, "python.exe"), (501, 500, "chrome.exe")])
    assert process_tree.descendants(p, 42, "chrome.exe").count() == 300 - 42 + 1
    assert process_tree.orphans(p, "chrome.exe").count() == 300


def test_pattern_join_takes_the_longest(spark):
    pages = spark.createDataFrame([(1, "https://list.example.org/a"), (2, "https://x.org/"), (3, "https://a.b/"), (4, "nothing")], "page_id long, url string")
    patterns = spark.createDataFrame([(".org", 4), ("list.example.org", 2), ("example.org", 9)], "pattern string, tier int")
    from tieproof.functions.urls import netloc

    got = {r["page_id"]: r["tier"] for r in joins.pattern_tiers(pages, patterns, F.lower(netloc(F.col("url"))), 3).collect()}
    assert got == {1: 2, 2: 4, 3: 3, 4: 3}


def test_rank_filters_run_before_the_shuffle(spark):
    from tieproof.operators.stats import engine_health

    df = spark.range(100).select(
        F.concat(F.lit("h"), F.col("id") % 1).alias("path"), F.lit("ok").alias("outcome"), F.col("id").alias("event_id"),
        F.timestamp_seconds("id").alias("ts"), F.col("id").alias("latency_ms"))
    plan = engine_health(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan

"""Ordered operators against plain loops, with one key holding most rows and tiny blocks."""

import random

import pytest
from pyspark.sql import functions as F

from tieproof.operators import logs, ordered, requests


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(7)
    out = []
    for i in range(600):
        key = 0 if rnd.random() < 0.6 else rnd.randrange(1, 6)
        out.append((key, 1_000_000 * rnd.randrange(0, 500_000), i, rnd.random() < 0.45, rnd.randrange(0, 120)))
    return out


@pytest.fixture(scope="module")
def log(spark, rows):
    df = spark.createDataFrame(rows, "session_id long, us long, event_id long, ok boolean, latency_ms long")
    return df.withColumn("ts", F.timestamp_micros("us")).withColumn("http_status", F.when(F.col("ok"), 200).otherwise(503)).repartition(4)


def by_session(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(r[0], []).append(r)
    return groups


@pytest.mark.parametrize("parts", [1, 9, 60])
def test_position(log, rows, parts):
    got = {r["event_id"]: r["pos"] for r in logs.positioned(log, parts).collect()}
    want = {r[2]: i for g in by_session(rows).values() for i, r in enumerate(g)}
    assert got == want


def test_a_burst_is_cut_into_even_parts(spark):
    n = 4000  # nine tenths of one session inside one second, half of those at one time
    df = spark.range(n).select(
        F.when(F.col("id") % 20 == 0, 2).otherwise(1).alias("session_id"), F.col("id").alias("event_id"),
        F.when(F.col("id") % 10 == 0, F.col("id") * 1_000_000).when(F.col("id") % 2 == 0, 5_000_000_000).otherwise(5_000_000_000 + F.col("id"))
        .alias("us"))
    df = df.withColumn("ts", F.timestamp_micros("us"))
    got = {r["event_id"]: (r["session_id"], r["us"], r["pos"]) for r in logs.positioned(df, 16).collect()}
    for s in (1, 2):
        own = sorted((us, e) for e, (key, us, _) in got.items() if key == s)
        assert [got[e][2] for _, e in own] == list(range(len(own)))
    dealt = df.repartitionByRange(16, "session_id", "ts", "event_id").groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) == 16 and max(r["count"] for r in dealt) < 2 * n / 16


@pytest.mark.parametrize("size", [7, 25, 100_000])
def test_rolling(log, rows, size):
    got = {r["event_id"]: r["n"] for r in ordered.rolling(
        logs.positioned(log), ["session_id"], 6, {"n": F.count_if("ok")}, size=size).collect()}
    want = {r[2]: sum(x[3] for x in g[max(0, i - 5): i + 1]) for g in by_session(rows).values() for i, r in enumerate(g)}
    assert got == want


@pytest.mark.parametrize("size", [3, 50, 100_000])
def test_running(log, rows, size):
    p = logs.positioned(log)
    out = ordered.running(p, ["session_id"], {"hi": ("max", F.col("latency_ms")), "s": ("sum", F.col("latency_ms"))}, size=size)
    out = ordered.running(out, ["session_id"], {"lo": ("min", F.col("latency_ms"))}, upto=-1, size=size)
    got = {r["event_id"]: (r["hi"], r["s"], r["lo"]) for r in out.collect()}
    want = {}
    for g in by_session(rows).values():
        v = [r[4] for r in g]
        for i, r in enumerate(g):
            want[r[2]] = (max(v[: i + 1]), sum(v[: i + 1]), min(v[:i]) if i else None)
    assert got == want


@pytest.mark.parametrize("size", [4, 100_000])
def test_fail_streak_and_breaker(log, rows, size):
    got = {r["event_id"]: (r["fail_streak"], r["breaker_open"]) for r in
           logs.fail_streaks(log, F.col("ok"), trip=3, size=size).collect()}
    want = {}
    for g in by_session(rows).values():
        streak, is_open = 0, False
        for r in g:
            streak = 0 if r[3] else streak + 1
            is_open = is_open or streak >= 3
            want[r[2]] = (streak, is_open)
    assert got == want


def test_alarm_hysteresis(log, rows):
    got = {r["event_id"]: (r["alarm"], r["edge"]) for r in logs.alarm_edges(log, "latency_ms", 90, 75).collect()}
    want = {}
    for g in by_session(rows).values():
        on = False
        for r in g:
            was = on
            on = True if r[4] >= 90 else False if r[4] < 75 else on
            want[r[2]] = (on, "raised" if on and not was else "cleared" if was and not on else None)
    assert got == want


@pytest.mark.parametrize("size", [9, 100_000])
def test_trailing_count(spark, rows, size):
    df = spark.createDataFrame([(r[2], r[1]) for r in rows], "seq long, us long").withColumn("ts", F.timestamp_micros("us"))
    got = {r["seq"]: r["n"] for r in ordered.trailing_count(df, [], "ts", "seq", 900, "n", size).collect()}
    want = {r[2]: sum(1 for x in rows if (x[1], x[2]) < (r[1], r[2]) and r[1] - x[1] < 900_000_000) for r in rows}
    assert got == want


def test_batches_of_requests(spark):
    df = spark.range(45).withColumn("doc_id", F.col("id") * F.col("id")).repartition(3)
    got = requests.batch_requests(df, "doc_id", {"n": F.col("id")}, 20).orderBy("batch_no").collect()
    assert [r["n_rows"] for r in got] == [20, 20, 5]
    assert got[2]["request"].split("\n")[0] == '{"idx":0,"n":40}'


def test_backoff_delays(spark):
    t = [(1, i, i, s) for i, s in enumerate([503, 503, 200, 429, 429, 429, 429, 429, 503])]
    df = spark.createDataFrame(t, "session_id long, event_id long, s long, http_status int").withColumn("ts", F.timestamp_seconds("s"))
    got = [r["delay_s"] for r in logs.backoff(df).orderBy("event_id").collect()]
    assert got == [2.0, 4.0, 60.0, 120.0, 240.0, 480.0, 600.0, 60.0]


def test_dry_rounds(spark):
    calls = [(1, r, "parsed" if r in (0, 5) else "empty") for r in range(9)]
    df = spark.createDataFrame(calls, "session_id long, round int, outcome string")
    got = [(r["dry_streak"], r["cooldown_s"]) for r in logs.dry_streaks(df).orderBy("round").collect()]
    assert got == [(0, 0.0), (1, 300.0), (2, 450.0), (3, 675.0), (4, 1012.5), (0, 0.0), (1, 300.0), (2, 450.0), (3, 675.0)]


def test_restart_guard(spark):
    crash = "Traceback (most recent call last)"
    lines = [(i, i, t, crash) for i, t in enumerate((0, 100, 200, 300, 2000))]
    lines += [(9, 9, 310, "SESSION ENDED"), (10, 10, 311, "CAPTCHA detected"), (11, 10, 2100, "CAPTCHA cleared")]
    df = spark.createDataFrame(lines, "seq long, run_id long, s long, line string").withColumn("ts", F.timestamp_seconds("s"))
    got = {r["seq"]: (r["exit_kind"], r["recent"], r["allowed"]) for r in logs.restarts(df).collect()}
    assert got == {0: ("crash", 0, True), 1: ("crash", 1, True), 2: ("crash", 2, True), 3: ("crash", 3, False), 9: ("clean", 4, True),
                   4: ("crash", 0, True), 11: ("unknown", 1, True)}


def test_run_report(spark):
    lines = [(1, 1, 0, "Still waiting... elapsed=44s"), (2, 1, 1, "Still waiting... elapsed=638s"), (3, 1, 2, "DB total: 7"),
             (4, 1, 3, "DB total: 9"), (5, 2, 3, "CAPTCHA detected"), (6, 3, 3, "CAPTCHA detected"), (7, 3, 3, "CAPTCHA cleared"),
             (8, 3, 3, "SESSION ENDED"), (9, 4, -2000, "Traceback (most recent call last) in run")]
    df = spark.createDataFrame(lines, "seq long, run_id long, s long, line string").withColumn("ts", F.timestamp_seconds(F.col("s") + 5000))
    got = {r["run_id"]: tuple(r)[1:] for r in logs.run_report(df).collect()}
    assert got == {1: ("unknown", 638, False, 9, "hang"), 2: ("unknown", 0, True, None, "wall"),
                   3: ("clean", 0, False, None, "healthy"), 4: ("crash", 0, False, None, "frozen")}


@pytest.mark.parametrize("size", [1, 3, 100])
def test_null_keys_are_keys_in_running_values(spark, size):
    rows = [(None if i % 3 == 0 else i % 3, i, i * 7 % 11) for i in range(40)]
    df = ordered.with_position(spark.createDataFrame(rows, "k int, o int, v int"), ["k"], ["o"])
    got = {r["o"]: (r["total"], r["least"]) for r in ordered.running(
        df, ["k"], {"total": ("sum", F.col("v")), "least": ("min", F.col("v"))}, size=size).collect()}
    want = {}
    for k in (None, 1, 2):
        seen = []
        for key, o, v in rows:
            if key == k:
                seen.append(v)
                want[o] = (sum(seen), min(seen))
    assert got == want


def test_logs_without_a_session_are_a_session(spark):
    rows = [(None, i, i, "ok" if i == 5 else "timeout") for i in range(9)] + [(1, 100, 1, "ok")]
    log = spark.createDataFrame(rows, "session_id long, event_id long, s long, outcome string").withColumn("ts", F.timestamp_seconds("s"))
    got = {r["event_id"]: (r["fail_streak"], r["breaker_open"]) for r in logs.fail_streaks(log, F.col("outcome") == "ok", size=4).collect()}
    assert got == {**{i: (i + 1 if i < 5 else i - 5, i >= 4) for i in range(9)}, 100: (0, False)}


@pytest.mark.parametrize("size", [7, 40, 1000])
def test_counts_of_the_last_rows(spark, size):
    """Several frames in one pass, blocks smaller than a key, null keys and null values."""
    r = random.Random(9)
    rows = [(k, p, r.choice(["a", "b", None])) for k, n in (("x", 300), (None, 50), ("y", 3)) for p in range(n)]
    df = spark.createDataFrame(rows, "key string, pos long, v string")
    got = ordered.rolling_counts(df, ["key"], {"a7": (7, F.col("v") == "a"), "b2": (2, F.col("v") == "b")}, size=size).collect()
    by_key = {k: [v for q, _, v in rows if q == k] for k in ("x", None, "y")}
    assert len(got) == len(rows)
    for g in got:
        before = by_key[g.key][:g.pos + 1]
        assert (g.a7, g.b2) == (before[-7:].count("a"), before[-2:].count("b"))

import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tieproof.config import Config
from tieproof.plans import store
from tieproof.session import scratch
from tieproof.sources import writers
from tieproof.streaming import jobs, keyed, run
from tieproof.streaming.ladder import levels, observations

CFG = Config()


def plain(rows):
    """Levels of one session, row by row."""
    level, since, healthy, resets, round_before = 1, None, None, 0, None
    calls, fetches, streak = [], [], {"full_prompt": 0, "sample": 0}
    out = []
    for _, us, round_, kind, outcome in sorted(rows, key=lambda r: (r[1], r[0], r[3])):
        now = us / 1e6
        healthy = now if healthy is None else healthy
        if round_before not in (None, round_) and level > 1:
            if now - since > 3600 or resets >= 3:
                level = 5
            elif now - since > 900:
                level, since, healthy, resets, calls, fetches = 1, None, now, resets + 1, [], []
        round_before = round_
        if kind == "call":
            calls = [*calls, outcome][-20:]
            if calls[-5:] == ["prompt_echoed"] * 5:
                level = max(level, 3)
            elif len(calls) == 20 and calls.count("parsed") < 14:
                level = max(level, 2)
        elif kind == "fetch":
            fetches = [*fetches, outcome == "ok"][-20:]
            if len(fetches) == 20 and sum(fetches) < 10:
                level = max(level, 4)
        elif outcome == "ok":
            at, needed, to = {"full_prompt": (2, 10, 1), "sample": (3, 2, 2)}[kind]
            streak[kind] += 1
            if level == at and streak[kind] >= needed:
                level, streak[kind] = to, 0
        if level == 1:
            since, healthy = None, now
        elif since is None:
            since = now
            resets = 0 if now - healthy > 900 else resets
        out.append((level, resets))
    return out


def played(spark, sessions, size=100_000):
    schema = "session_id long, event_id long, us long, round int, kind string, outcome string"
    log = spark.createDataFrame([(s, *r) for s, rows in sessions.items() for r in rows], schema)
    at = {(s, r[0], r[3]): r[1] for s, rows in sessions.items() for r in rows}
    got = {s: [] for s in sessions}
    for r in sorted(levels(log, size).collect(), key=lambda r: (at[r.session_id, r.event_id, r.kind], r.event_id, r.kind)):
        got[r.session_id].append((r.level, r.resets))
    return got


def steps(*parts):
    """Rows of (seconds, round, kind, outcome, times)."""
    rows = [(s, r, k, o) for s, r, k, o, n in parts for _ in range(n)]
    return [(i, int(s * 1e6) + i, r, k, o) for i, (s, r, k, o) in enumerate(rows)]


def test_levels_of_known_logs(spark):
    bad, hour = ("captcha", 15), 3600
    spells = [x for k in range(5) for x in ((k * 901, k, "fetch", *bad), (k * 901, k, "fetch", "ok", 5))]
    cases = {
        1: (steps((0, 0, "call", "parsed", 7), (0, 0, "call", "empty", 12)), (1, 0)),
        2: (steps((0, 0, "call", "parsed", 7), (0, 0, "call", "empty", 13)), (2, 0)),
        3: (steps((0, 0, "call", "prompt_echoed", 5)), (3, 0)),
        4: (steps((0, 0, "call", "empty", 20), (1, 0, "full_prompt", "ok", 10)), (1, 0)),
        5: (steps((0, 0, "call", "prompt_echoed", 5), (1, 0, "sample", "ok", 2)), (2, 0)),
        6: (steps((10, 0, "fetch", *bad), (10, 0, "fetch", "ok", 5)), (4, 0)),
        7: (steps((10, 0, "fetch", *bad), (10, 0, "fetch", "ok", 5), (920, 1, "fetch", "ok", 1)), (1, 1)),
        8: (steps((5, 0, "call", "prompt_echoed", 5), (hour + 60, 1, "call", "parsed", 1)), (5, 0)),
        9: (steps(*spells), (5, 3)),
        10: (steps((0, 0, "fetch", *bad), (0, 0, "fetch", "ok", 5), (902, 1, "fetch", "ok", 1), (902, 1, "fetch", "ok", 4),
                   (903, 1, "fetch", "captcha", 14), (4000, 1, "fetch", "captcha", 1)), (4, 0)),
    }
    got = played(spark, {k: rows for k, (rows, _) in cases.items()}, size=20)
    assert {k: v[-1] for k, v in got.items()} == {k: last for k, (_, last) in cases.items()}
    assert all(got[k] == plain(rows) for k, (rows, _) in cases.items())


def random_log(rnd, n):
    us, rows = 0, []
    for i in range(n):
        us += rnd.choice([0, 1, 10, 60, 400, 1000]) * 1_000_000
        good = rnd.random() < (0.9 if i // 40 % 2 else 0.2)
        kind = rnd.choice(["call", "call", "fetch", "fetch", "full_prompt", "sample"])
        outcome = rnd.choice(["parsed", "ok"]) if good else rnd.choice(["prompt_echoed"] * 8 + ["empty", "timeout"])
        rows.append((i, us, i // 7, kind, outcome if kind in ("call", "fetch") else "ok"))
    return rows


def test_levels_of_random_logs(spark):
    rnd = random.Random(5)
    sessions = {s: random_log(rnd, 400 if s else 1) for s in range(12)}
    got = played(spark, sessions, size=64)
    assert all(got[s] == plain(rows) for s, rows in sessions.items())
    seen = {x for v in got.values() for x in v}
    assert {level for level, _ in seen} == {1, 2, 3, 4, 5} and {resets for _, resets in seen} >= {0, 1, 2, 3}


@pytest.mark.parametrize("size", [20, 64, 1000])
def test_one_session_is_walked_in_blocks(spark, size):
    """Most rows in one session, another one without a name; spells, resets and streaks cross block bounds."""
    rnd = random.Random(9)
    sessions = {1: random_log(rnd, 900), None: random_log(rnd, 120), 2: random_log(rnd, 30)}
    calm = [(i, i * 1_000_000, 0, "call", "prompt_echoed" if i < 5 else "parsed") for i in range(300)]
    sessions[3] = calm + [(300, 400_000_000, 0, "sample", "ok"), (301, 401_000_000, 0, "sample", "ok")]
    got = played(spark, sessions, size=size)
    assert all(got[s] == plain(rows) for s, rows in sessions.items())


def test_levels_do_not_depend_on_batches(spark):
    rnd = random.Random(6)
    schema = "session_id long, event_id long, us long, round int, call string, fetch string"
    rows = [(s, i, 1_000_000 * 300 * i, i // 10, rnd.choice(["parsed", "prompt_echoed", "empty"]), rnd.choice(["ok", "timeout"]))
            for s in (1, 2) for i in range(90)]
    found = []
    for parts in (1, 4):
        mixed, path = rnd.sample(rows, len(rows)), scratch(spark)  # earlier rows in later batches
        for k in range(parts):
            spark.createDataFrame(mixed[k::parts], schema).coalesce(1).write.mode("append").parquet(path)
        stream = run.follow(spark, path, schema, maxFilesPerTrigger="1").withColumn("ts", F.timestamp_micros("us"))
        log = run.drain_to_log(observations(stream.withColumn("outcome", F.col("call")), stream.withColumn("outcome", F.col("fetch"))))
        found.append(sorted(map(tuple, levels(log).collect())))
    assert found[0] == found[1] and len(found[0]) == 360


def test_store_sink_over_three_batches_equals_one_merge(spark):
    schema = ("rec_seq long, company_name string, founder string, founders string, description string, affiliation_type string, "
              "evidence string, proof_url string, source_url string, status string, verified boolean")
    rows = [(i, f"Firm {100 + i % 7}", "Ann Lee", "", "" if i < 9 else f"d{i % 7}", "Alumni", "Ann Lee founded it in 1999",
             "https://a.org/x", f"https://s{i % 3}", "unknown" if i < 5 else "active", False) for i in range(21)]
    path = scratch(spark)
    for k in range(3):
        spark.createDataFrame(rows[7 * k: 7 * k + 7], schema).coalesce(1).write.mode("append").parquet(path)
    sink = jobs.StoreSink(scratch(spark), CFG)
    run.drain_each_batch(run.follow(spark, path, schema, maxFilesPerTrigger="1"), sink)
    once, _, _ = store.upsert(None, None, spark.createDataFrame(rows, schema), CFG)
    cols = sorted(c for c in once.columns)
    got = sorted(tuple(r[c] for c in cols) for r in sink.result(spark).collect())
    assert got == sorted(tuple(r[c] for c in cols) for r in once.collect()) and len(got) == 7


def store_rows(ids, firm):
    schema = ("rec_seq long, company_name string, founder string, founders string, description string, affiliation_type string, "
              "evidence string, proof_url string, source_url string, status string, verified boolean")
    return [(i, f"Firm {firm(i)}", "Ann Lee", "", f"d{i}", "Alumni", "Ann Lee founded it in 1999",
             "https://a.org/x", f"https://s{i % 3}", "active", False) for i in ids], schema


def test_store_sink_rewrites_touched_buckets_only(spark):
    import os

    first, schema = store_rows(range(60), lambda i: 100 + i)
    second, _ = store_rows(range(60, 62), lambda i: 105)
    frame = lambda rows: spark.createDataFrame(rows, schema)
    sink = jobs.StoreSink(scratch(spark), CFG, buckets=16)

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{sink.path}/store") for f in fs}

    sink(frame(first), 0)
    before, whole = files(), {r.name_key: r.description for r in sink.result(spark).collect()}
    for _ in range(2):  # batch 7 follows batch 0, and is replayed
        sink(frame(second), 7)
        assert {f: t for f, t in files().items() if "version=0" in f} == before
        now = sink.manifest(spark)
        assert sorted(now.values()).count(7) == 1 and len(now) == len(sink.manifest(spark, 7)) > 8
        got = {r.name_key: (r.description, r.n_sources) for r in sink.result(spark).collect()}
        assert {k: d for k, (d, _) in got.items()} == whole and sorted(n for _, n in got.values())[-1] == 3
    assert len([f for f in files() if "version=7" in f and f.endswith(".parquet") and "/." not in f]) == 1
    sink(frame([]), 8)
    assert sink.manifest(spark) == now


def test_publish_counts_versions(spark):
    path = scratch(spark)
    writers.publish(spark.range(3), path)
    first = writers.current(spark, path)
    assert writers.publish(spark.range(5), path) == 1
    assert first.count() == 3 and writers.current(spark, path).count() == 5
    with pytest.raises(AnalysisException):
        writers.publish(spark.range(7), path, version=1)
    assert writers.current(spark, path).count() == 5


def test_late_rows_count(spark):
    days = [10, 11, 2]  # the last file is older than the others
    path = scratch(spark)
    for k, d in enumerate(days):
        rows = [(k * 10 + i, f"u{i}", d // 10 * 20, f"2024-01-{d:02d} 01:00:00", "parsed" if i else "empty", "http", 10 * i) for i in range(3)]
        spark.createDataFrame(rows, "event_id long, url string, round int, ts string, outcome string, path string, latency_ms long").withColumn(
            "ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(path)
    schema = "event_id long, url string, round int, ts timestamp, outcome string, path string, latency_ms long"
    stream = run.follow(spark, path, schema, maxFilesPerTrigger="1")
    seen = {tuple(r) for r in jobs.visited(run.drain_to_log(stream, jobs.visits_of)).collect()}
    assert seen == {(f"u{i}", e) for i in range(3) for e in (0, 1)}
    got = jobs.round_metrics(run.drain_to_log(stream, jobs.call_sums), run.drain_to_log(stream, jobs.fetch_sums)).collect()
    assert {(r.day.day, r.calls, r.parsed, r.avg_latency_ms, r.path_http) for r in got} == {(d, 3, 2, 10, 3) for d in days}


def test_companies_of_any_size_are_rows(spark):
    people = spark.createDataFrame([("A", i + 1, f"P{i}", f"S{i % 2}") for i in range(5)] + [("B", 1, "Q", "")],
                                   "company string, pos int, person string, school string")
    records = spark.createDataFrame([("A", "high"), ("B", "weak"), ("C", "weak")], "company_name string, validation_tier string")
    flat = writers.companies_flat(records, people)
    assert set(writers.COMPANY_COLUMNS[1:]) <= set(flat.columns)
    got = {(r["company"], r["name"], r["pos"]): (r["member_count"], r["schools"]) for r in flat.collect()}
    assert got == {**{("A", f"P{i}", i + 1): (5, "S0; S1") for i in range(5)}, ("B", "Q", 1): (1, ""), ("C", None, None): (0, "")}


# --- keyed state ----------------------------------------------------------------


def fed(spark, rows, schema, parts, job):
    """The log of ``job`` over ``rows`` cut into ``parts`` files, each a micro-batch; and of a replay from its checkpoint."""
    path = scratch(spark)
    for k in range(parts):
        cut = rows[k * len(rows) // parts:(k + 1) * len(rows) // parts]
        spark.createDataFrame(cut, schema).coalesce(1).write.parquet(f"{path}/{k:03}")
    stream = run.follow(spark, f"{path}/*", schema, maxFilesPerTrigger="1", latestFirst="false")
    base = scratch(spark)

    def play():
        job(stream).writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{base}/checkpoint").trigger(
            availableNow=True).start(f"{base}/table").awaitTermination()
        return sorted(map(tuple, spark.read.parquet(f"{base}/table").collect()), key=str)

    first = play()
    assert play() == first  # nothing new: nothing is said twice
    return first


def attempts_log(rows):
    out, pool = [], {}
    for key, event, second, outcome in rows:
        failures, place = pool.get(key, (0, "new"))
        failures += outcome != "ok"
        now = ("promoted" if failures else "new") if outcome == "ok" else "parked" if failures > 5 else "demoted"
        if now != place:
            out.append((key, second * 1_000_000, event, now, failures))
        pool[key] = failures, now
    return sorted(out, key=str)


def test_candidates_are_promoted_and_demoted_over_batches(spark):
    rnd = random.Random(12)
    rows = [(rnd.choice([None, 1, 1, 1, 2, 3]), i, i // 2, rnd.choice(["ok", "ok", "timeout", "empty"])) for i in range(120)]
    for parts in (1, 4):
        got = fed(spark, rows, "session_id long, event_id long, s long, outcome string", parts,
                  lambda s: keyed.candidate_log(s.withColumn("ts", F.timestamp_seconds("s"))))
        assert got == attempts_log(rows)
    assert {"promoted", "demoted", "parked"} == {r[3] for r in got}


def test_illegal_steps_are_rejected_over_batches(spark):
    asked = [(1, "new"), (2, "verifying"), (1, "queued"), (2, "new"), (1, "verified"), (1, "verifying"), (2, "queued"), (1, "verified"),
             (1, "queued"), (2, "verifying"), (2, "needs_human"), (2, "rejected"), (3, None), (2, "verified")]
    rows = [(d, i, s) for i, (d, s) in enumerate(asked)]
    place, want = {}, []
    for d, i, s in rows:
        was = place.get(d)
        fits = s == "new" if was is None else s in keyed.ALLOWED.get(was, ())
        want.append((d, i, s, was, fits))
        place[d] = s if fits else was
    for parts in (1, 5):
        assert fed(spark, rows, "doc_id long, step int, state string", parts, keyed.state_log) == sorted(want, key=str)
    assert place == {1: "verified", 2: "rejected", 3: None}


def test_silent_runs_raise_alarms(spark):
    minute = 60
    rows = [(1, 0, 0, "a"), (2, 1, 0, "a"), (3, 2, 0, "SESSION ENDED"),
            (1, 3, 10 * minute, "b"), (2, 4, 14 * minute, "b"), (4, 5, 20 * minute, "a"),
            (2, 6, 28 * minute, "c"), (4, 7, 30 * minute, "b"), (1, 8, 50 * minute, "back"),
            (4, 9, 55 * minute, "SESSION ENDED"), (2, 10, 55 * minute, "end"), (5, 11, 90 * minute, "clock")]
    us = lambda m: m * minute * 1_000_000
    want = sorted([
        (1, us(25), "stalled", us(10)), (1, us(50), "resumed", us(10)), (1, us(65), "stalled", us(50)),
        (2, us(43), "stalled", us(28)), (2, us(55), "resumed", us(28)), (2, us(70), "stalled", us(55)),
        (4, us(45), "stalled", us(30)), (4, us(55), "resumed", us(30))], key=str)
    for parts in (1, 4, 12):
        got = fed(spark, rows, "run_id long, seq long, s long, line string", parts, lambda s: keyed.stall_alarms(
            s.withColumn("ts", F.timestamp_seconds("s")).withWatermark("ts", "0 seconds"), ended=("SESSION ENDED",)))
        assert got == want


@pytest.mark.parametrize("slots", [1, 3])
def test_keys_of_a_slot_share_state_and_timers(spark, monkeypatch, slots):
    """One state holds many keys: some with rows, some whose time has passed, in the same batch and without rows."""
    held = keyed.stateful
    monkeypatch.setattr(keyed, "stateful", lambda *a, **k: held(*a, **k, slots=slots))
    big = 1 << 60  # no double holds these keys
    shown = [k for i in range(3) for k in range(40) if k % 4 >= i]
    last = {k: 60 + 20 * at for at, k in enumerate(shown)}
    rows = [(None if k == 0 else big + k, at, 60 + 20 * at, "line") for at, k in enumerate(shown)]
    rows += [(big + 99, 900, 9000, "clock"), (big + 99, 901, 9001, "clock")]
    want = sorted([(None if k == 0 else big + k, (s + 900) * 1_000_000, "stalled", s * 1_000_000) for k, s in last.items()], key=str)
    for parts in (1, 3):
        assert fed(spark, rows, "run_id long, seq long, s long, line string", parts, lambda s: keyed.stall_alarms(
            s.withColumn("ts", F.timestamp_seconds("s")).withWatermark("ts", "0 seconds"))) == want


def test_states_are_those_of_slots(spark):
    path = scratch(spark)
    spark.range(400).select(F.col("id").alias("doc_id"), F.lit(1).alias("step"), F.lit("new").alias("state")).write.parquet(path)
    stream = run.follow(spark, path, "doc_id long, step int, state string")
    log = keyed.stateful(stream, ["doc_id"], ["step"], ["step"], lambda key, place, rows, passed: ((1,), [(len(rows),)], None),
                         "n int", "n int", slots=7)
    query = log.writeStream.format("memory").queryName("slots").option("checkpointLocation", scratch(spark)).trigger(availableNow=True).start()
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) == 7
    assert spark.table("slots").agg(F.count("*"), F.count_distinct("doc_id"), F.sum("n")).first() == (400, 400, 400)


def test_more_documents_than_slots_add_no_states(spark):
    path, table, n = scratch(spark), scratch(spark), 6000
    second = "struct(2 AS step, IF(id % 3 = 0, 'verified', 'queued') AS state)"  # a third of the documents ask for a step that is not allowed
    spark.range(n).selectExpr("id AS doc_id", f"inline(array(struct(1 AS step, 'new' AS state), {second}))").write.parquet(path)
    log = keyed.state_log(run.follow(spark, path, "doc_id long, step int, state string"))
    query = log.writeStream.format("parquet").option("checkpointLocation", scratch(spark)).trigger(availableNow=True).start(table)
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) < n
    got = sorted(map(tuple, spark.read.parquet(table).collect()), key=str)
    assert got == sorted([(i, 1, "new", None, True) for i in range(n)]
                         + [(i, 2, "queued" if i % 3 else "verified", "new", i % 3 > 0) for i in range(n)], key=str)


def test_states_of_a_slot_are_lists_of_fields(spark):
    """States outlive batches with all fields, null or not; a key costs few bytes, since a batch hands over all keys of a slot that it meets."""
    path, table, n = scratch(spark), scratch(spark), 20000

    def step(key, state, rows, passed):
        count, odd, last = state or (0, None, None)
        after = count + len(rows), True if int(key[0]) % 2 else None, rows[-1][1]
        return (None if rows[-1][1] == "gone" else after), [(count, odd, last)], None

    said = "CASE WHEN id % 5 = 0 THEN 'gone' WHEN id % 3 = 0 THEN NULL ELSE concat('w', id % 3) END AS word"
    for k in range(3):
        spark.range(n).selectExpr("id AS a", "IF(id % 4 = 0, NULL, id % 4) AS b", f"{k} AS step", said).coalesce(1).write.parquet(f"{path}/{k}")
    stream = run.follow(spark, f"{path}/*", "a long, b long, step int, word string", maxFilesPerTrigger="1")
    log = keyed.stateful(stream, ["a", "b"], ["step", "word"], ["step"], step, "count long, odd boolean, last string",
                         "count long, odd boolean, last string", slots=8)
    query = log.writeStream.format("parquet").option("checkpointLocation", scratch(spark)).trigger(availableNow=True).start(table)
    query.awaitTermination()
    want = []
    for i in range(n):
        gone, word = i % 5 == 0, f"w{i % 3}" if i % 3 else None
        want += [(i, i % 4 or None, *((0, None, None) if k == 0 or gone else (k, True if i % 2 else None, word))) for k in range(3)]
    assert sorted(map(tuple, spark.read.parquet(table).collect()), key=str) == sorted(want, key=str)
    assert len(query.recentProgress) == 3
    states = query.recentProgress[-1]["stateOperators"][0]
    assert states["memoryUsedBytes"] < 150 * n

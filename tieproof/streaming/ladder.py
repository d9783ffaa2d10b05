"""The degradation level of each session, from its log of calls and fetches.

Levels: 1 normal, 2 demoted, 3 scrape only, 4 backlog, 5 hard stop. Event time
stands in for the wall clock, and a change of the session's round is its tick.

What the windows hold does not depend on the level, so it is counted for all rows
at once by the ordered operators; the level only decides from which row on a
window counts. What is left is a walk over the few rows at which something may
happen (marks), with the level, the start of the bad spell, the resets and the
places of the last reset as its state. Sessions are walked in blocks, all at once,
and blocks that began from another state than they have are walked again. The
levels in between are those of the last mark. The log may arrive in any batches and any order: levels follow from the
whole log, see ``run.LogSink``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieproof.operators.ordered import BLOCK, rolling, rolling_counts, running, with_position
from tieproof.session import written

# Levels, times and limits of the ladder.
NORMAL, DEMOTED, SCRAPE_ONLY, BACKLOG, STOPPED = 1, 2, 3, 4, 5
RETRY_AFTER_S, STOP_AFTER_S, HEALTHY_S = 15 * 60, 60 * 60, 15 * 60
MAX_RESETS = 3
SECOND = 1_000_000
#: What raises the level: kind of row, outcome that is counted, rows of the window, when it fires.
RAISES = {
    SCRAPE_ONLY: ("call", "prompt_echoed", 5, lambda n: n == 5),
    DEMOTED: ("call", "parsed", 20, lambda n: n < 14),
    BACKLOG: ("fetch", "ok", 20, lambda n: n < 10),
}
#: What lowers it: kind of row, level it holds at, successes needed, level reached.
LOWERS = {"full_prompt": (DEMOTED, 10, NORMAL), "sample": (SCRAPE_ONLY, 2, DEMOTED)}

KEY, ORDER = ["session_id"], ["us", "event_id", "kind"]


def observations(calls: DataFrame, fetches: DataFrame) -> DataFrame:
    """Both logs in one: session_id, event_id, us, round, kind, outcome."""
    def part(df: DataFrame, kind: str) -> DataFrame:
        return df.select(
            "session_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "round",
            F.lit(kind).alias("kind"), "outcome",
        )

    return part(calls, "call").union(part(fetches, "fetch"))


def _is(kind: str) -> Column:
    return F.col("kind") == kind


def _placed(places: DataFrame, size: int) -> DataFrame:
    """Rows with the calls and fetches so far, and the row before."""
    rows = running(places, KEY, {k: ("sum", _is(k).cast("long")) for k in ("call", "fetch")}, size=size)
    return rolling(rows, KEY, 2, {"us_before": F.first("us"), "round_before": F.first("round")}, size=size)


def _marks(rows: DataFrame, size: int) -> DataFrame:
    """Rows at which the level may change: ``fires`` lists (level, rows its window needs).

    The windows of both kinds are counted in one pass over all rows.
    """
    nth = F.when(_is("call"), F.col("call") - 1).when(_is("fetch"), F.col("fetch") - 1).otherwise(F.col("pos"))
    counts = {f"in{level}": (n, F.col("outcome") == outcome) for level, (_, outcome, n, _) in RAISES.items()}
    counted = rolling_counts(rows.withColumn("nth", nth), [*KEY, "kind"], counts, pos="nth", size=size)
    fires = [F.when(_is(of) & when(F.col(f"in{level}")) & (F.col(of) >= n), F.lit(level)) for level, (of, _, n, when) in RAISES.items()]
    marked = counted.withColumns({"fires": F.array_compact(F.array(*fires)), "tick": F.col("round") != F.col("round_before")})
    asked = (F.size("fires") > 0) | F.col("tick") | ((F.col("outcome") == "ok") & F.col("kind").isin(*LOWERS))
    return marked.where(asked).select(*KEY, "pos", "kind", "us", "us_before", "tick", "call", "fetch", "fires")


ENTRY = "level int, spell long, resets int, call long, fetch long, full_prompt int, sample int"
#: A session before its first row: windows need their rows anyway, so the last reset may lie any time back.
LONG_AGO = -max(n for _, _, n, _ in RAISES.values())
START = (NORMAL, None, 0, LONG_AGO, LONG_AGO, 0, 0)
_NAMES = [c.split()[0] for c in ENTRY.split(", ")]


def _left(s: dict, calls: int, fetches: int) -> tuple:
    """The state that a block leaves, in one form for all states that act alike from here on."""
    place = lambda kind, n: LONG_AGO if n - s[kind] >= -LONG_AGO else s[kind]
    streak = [min(s[kind], needed) for kind, (_, needed, _) in LOWERS.items()]
    return (s["level"], s["spell"], s["resets"], place("call", calls), place("fetch", fetches), *streak)


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Level and resets after each mark, and behind the marks of a block the state it leaves (``pos`` null).

    Blocks come one after the other, each in order; the state that a block starts
    from is in its rows, or else it is that of a new session.
    """
    block, s, calls, fetches = None, {}, 0, 0

    def leave(out):
        if block is not None:
            out.append((*block, None, None, None, *_left(s, calls, fetches)))

    columns = ["_s", "_blk", "pos", "at_level", "at_resets", *_NAMES]
    for pdf in itertools.chain(batches, [None]):
        out: list[tuple] = []
        if pdf is None:
            leave(out)
        else:
            for key, blk, pos, kind, us, before, tick, calls_, fetches_, fires, entry in pdf.itertuples(index=False):
                if (key, blk) != block:
                    leave(out)
                    values = START if entry is None else [entry[n] for n in _NAMES]
                    block, s = (key, blk), {n: None if v is None else int(v) for n, v in zip(_NAMES, values)}
                calls, fetches = calls_, fetches_
                healthy, level = before, s["level"]
                if tick and s["spell"] is not None:
                    bad = us - s["spell"]
                    if bad > STOP_AFTER_S * SECOND or s["resets"] >= MAX_RESETS:
                        level = STOPPED
                    elif bad > RETRY_AFTER_S * SECOND:
                        level, healthy, s["spell"], s["resets"] = NORMAL, us, None, s["resets"] + 1
                        s["call"], s["fetch"] = calls - (kind == "call"), fetches - (kind == "fetch")
                so_far = {"call": calls, "fetch": fetches}
                level = max([level, *(f for f in fires if so_far[kind] - s[kind] >= RAISES[f][2])])
                if kind in LOWERS:
                    at, needed, to = LOWERS[kind]
                    s[kind] += 1
                    if level == at and s[kind] >= needed:
                        level, s[kind] = to, 0
                if level == NORMAL:
                    s["spell"] = None
                elif s["spell"] is None:
                    s["spell"] = us
                    if us - healthy > HEALTHY_S * SECOND:
                        s["resets"] = 0
                s["level"] = level
                out.append((key, blk, pos, level, s["resets"], *[None] * len(_NAMES)))
        yield pd.DataFrame(out, columns=columns).astype({c: "Int64" for c in columns[1:]})


def _walked(marks: DataFrame) -> DataFrame:
    ready = marks.repartition("_s", "_blk").sortWithinPartitions("_s", "_blk", "pos")
    rows = ready.select("_s", "_blk", "pos", "kind", "us", "us_before", "tick", "call", "fetch", "fires", "entry")
    return written(rows.mapInPandas(_walk, f"_s string, _blk long, pos long, at_level int, at_resets int, {ENTRY}"))


def _known(marks: DataFrame) -> DataFrame:
    """``_s, pos, at_level, at_resets`` of all marks, walked by many tasks however few sessions there are.

    A walk over a block needs the state that the block before it leaves. All blocks
    are walked at once as if sessions began there; then, as long as some block was
    walked from another state than the one it has by now, those blocks alone are
    walked again. What a block leaves seldom depends on more than its last spell
    and its resets, so corrections die out after a few rounds; block by block they
    are right at the latest, whatever the log.
    """
    state = F.struct(*_NAMES)
    began = F.struct(*[F.lit(v).cast(c.split()[1]).alias(c.split()[0]) for v, c in zip(START, ENTRY.split(", "))])
    marks = written(marks.withColumn("entry", F.when(F.lit(False), began)))
    results = _walked(marks)
    left = results.where("pos IS NULL").select("_s", "_blk", state.alias("left"), began.alias("used"))
    results = [results.where("pos IS NOT NULL").select("_s", "_blk", "pos", "at_level", "at_resets")]
    one_each = left.groupBy("_s").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    while not one_each:
        has = F.lag("left").over(Window.partitionBy("_s").orderBy("_blk"))
        wrong = written(left.withColumn("entry", F.coalesce(has, began)).where("NOT (entry <=> used)").select("_s", "_blk", "entry"))
        if wrong.isEmpty():
            break
        again = _walked(marks.drop("entry").join(wrong, ["_s", "_blk"]))
        now = again.where("pos IS NULL").select("_s", "_blk", state.alias("left")).join(
            wrong.withColumnRenamed("entry", "used"), ["_s", "_blk"])
        left = written(left.join(wrong, ["_s", "_blk"], "left_anti").unionByName(now))
        results = [r.join(wrong, ["_s", "_blk"], "left_anti") for r in results]
        results.append(again.where("pos IS NOT NULL").select("_s", "_blk", "pos", "at_level", "at_resets"))
        if len(results) > 8:
            results = [written(reduce(DataFrame.unionByName, results))]
    return reduce(DataFrame.unionByName, results).drop("_blk")


def levels(log: DataFrame, size: int = BLOCK) -> DataFrame:
    """``session_id, event_id, kind, level, resets`` after every observation of ``log``.

    Rows without a session are a session of their own. ``size`` rows of a session
    are one task's work at most; results are the same for any.
    """
    places = with_position(log, KEY, ORDER)
    name = F.coalesce(F.concat(F.lit("="), F.col("session_id").cast("string")), F.lit(""))
    known = _known(_marks(_placed(places, size), size).withColumns({"_s": name, "_blk": F.floor(F.col("pos") / size).cast("long")}))
    # the last mark so far, as one number: its place, its level, its resets
    code = F.col("pos") * 64 + F.col("at_level") * 8 + F.col("at_resets")
    rows = places.select(*KEY, "event_id", "kind", "pos", name.alias("_s")).join(known, ["_s", "pos"], "left")
    out = running(rows, KEY, {"code": ("max", code)}, size=size)
    last = F.coalesce(F.col("code") % 64, F.lit(NORMAL * 8))
    return out.select(*KEY, "event_id", "kind", F.shiftright(last.cast("int"), 3).alias("level"), (last % 8).cast("int").alias("resets"))

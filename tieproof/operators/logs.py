"""Call, fetch and run logs read as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieproof.operators.ordered import BLOCK, last_n, rolling, running, trailing_count, with_position

# Markers in the log of a run.
CLEAN_MARKERS = ("SESSION ENDED", "Max rounds")
TRACEBACK = "Traceback (most recent call last)"
WAITING = r"Still waiting\.\.\. elapsed=(\d+)s"
STORE_TOTAL = r"DB total:\s*(\d+)"
WALL_SEEN, WALL_GONE = "CAPTCHA detected", "CAPTCHA cleared"

def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / 1_000_000


SESSION = ["session_id"]
IN_TIME = ["ts", "event_id"]


def positioned(log: DataFrame, parts: int | None = None) -> DataFrame:
    """Log rows with their rank in the session."""
    return with_position(log, SESSION, IN_TIME, parts=parts)


def last_n_rate(log: DataFrame, hit: Column, name: str, n: int = 20, size: int = BLOCK) -> DataFrame:
    """Share of hits among the last ``n`` rows; null before ``n`` were seen."""
    frames = {"_hits": F.count_if(hit), "_seen": F.count(F.lit(1))}
    out = rolling(positioned(log), SESSION, n, frames, size=size)
    rate = F.when(F.col("_seen") == n, F.col("_hits") / n)
    return out.withColumn(name, rate).drop("_hits", "_seen")


def recent_count(log: DataFrame, hit: Column, name: str, n: int = 5) -> DataFrame:
    return rolling(positioned(log), SESSION, n, {name: F.count_if(hit)})


def fail_streaks(log: DataFrame, ok: Column, trip: int = 5, size: int = BLOCK) -> DataFrame:
    """Failures since the last success, and whether the breaker is open (it stays open)."""
    rows = running(positioned(log), SESSION, {"_ok": ("max", F.when(ok, F.col("pos")))}, size=size)
    rows = rows.withColumn("fail_streak", F.col("pos") - F.coalesce("_ok", F.lit(-1))).drop("_ok")
    tripped = F.when(F.col("fail_streak") >= trip, F.col("pos"))
    return running(rows, SESSION, {"_trip": ("min", tripped)}, size=size).withColumn(
        "breaker_open", F.col("_trip").isNotNull()
    ).drop("_trip")


def backoff(log: DataFrame, base: float = 2.0, longest: float = 60.0) -> DataFrame:
    """Delay before the next try of every failed fetch, without jitter.

    Rate-limited fetches start at a minute and stop at ten.
    """
    rows = fail_streaks(log, F.col("http_status") == 200).where("http_status <> 200")
    attempt = F.least(F.col("fail_streak") - 1, F.lit(30))
    limited = F.col("http_status") == 429
    start, stop = F.when(limited, 60.0).otherwise(base), F.when(limited, 600.0).otherwise(longest)
    return rows.withColumn("delay_s", F.least(start * F.pow(F.lit(2.0), attempt), stop))


def restarts(lines: DataFrame, seconds: int = 900, most: int = 3) -> DataFrame:
    """Exits of runs with their kind, the number of recent ones, and whether a relaunch is allowed.

    A closing banner is a clean exit, a traceback a crash; a run that shows
    neither ends with its last line, and how is unknown. A clean exit always allows a relaunch.
    """
    line = F.col("line")
    kind = F.when(line.contains(CLEAN_MARKERS[0]) | line.contains(CLEAN_MARKERS[1]), "clean").when(line.contains(TRACEBACK), "crash")
    marked = lines.withColumn("exit_kind", kind)
    silent = marked.groupBy("run_id").agg(F.max("seq").alias("seq"), F.count("exit_kind").alias("_n")).where("_n = 0")
    silent = marked.drop("exit_kind").join(silent.drop("_n"), ["run_id", "seq"], "left_semi").withColumn("exit_kind", F.lit("unknown"))
    exits = marked.where("exit_kind IS NOT NULL").unionByName(silent).withColumn("clean", F.col("exit_kind") == "clean")
    out = trailing_count(exits, [], "ts", "seq", seconds, "recent")
    return out.withColumn("allowed", F.col("clean") | (F.col("recent") < most))


def dry_streaks(calls: DataFrame, base: float = 300.0, factor: float = 1.5, longest: float = 3600.0) -> DataFrame:
    """Rounds without a new row in a row, and the pause that follows."""
    rounds = calls.groupBy("session_id", "round").agg(F.count_if(F.col("outcome") == "parsed").alias("new_rows"))
    rows = with_position(rounds, SESSION, ["round"])
    rows = running(rows, SESSION, {"_hit": ("max", F.when(F.col("new_rows") > 0, F.col("pos")))})
    streak = F.col("pos") - F.coalesce("_hit", F.lit(-1))
    pause = F.when(
        F.col("dry_streak") > 0,
        F.least(base * F.pow(F.lit(factor), F.least(F.col("dry_streak") - 1, F.lit(60))), F.lit(longest)),
    ).otherwise(0.0)
    return rows.withColumn("dry_streak", streak).withColumn("cooldown_s", F.round(pause, 3)).drop("_hit", "pos")


def alarm_edges(log: DataFrame, value: str, high: int = 90, low: int = 75) -> DataFrame:
    """Alarm with hysteresis: raised at ``high``, cleared below ``low``, one edge per episode."""
    v = F.col(value)
    mark = F.when(v >= high, F.col("pos") * 2 + 1).when(v < low, F.col("pos") * 2)
    rows = running(positioned(log), SESSION, {"_was": ("max", mark)}, upto=-1)
    now = F.greatest("_was", mark)  # the mark of the row itself is the latest, if it has one
    on, was = F.coalesce(now % 2, F.lit(0)) == 1, F.coalesce(F.col("_was") % 2, F.lit(0)) == 1
    edge = F.when(on & ~was, "raised").when(~on & was, "cleared")
    return rows.withColumns({"alarm": on, "edge": edge}).drop("_was")


def run_report(lines: DataFrame, frozen_s: int = 900, waiting_s: int = 600) -> DataFrame:
    """State of each run from its log: exit kind, longest wait, open wall, last total, alarm."""
    line, seq = F.col("line"), F.col("seq")
    clean = line.contains(CLEAN_MARKERS[0]) | line.contains(CLEAN_MARKERS[1])
    waited = F.regexp_extract(line, WAITING, 1).try_cast("long")
    total = F.regexp_extract(line, STORE_TOTAL, 1).try_cast("long")
    clock = lines.agg(F.max("ts")).scalar()
    out = lines.groupBy("run_id").agg(
        F.max(clean).alias("_clean"),
        F.max(line.contains(TRACEBACK)).alias("_trace"),
        F.coalesce(F.max(waited), F.lit(0)).alias("longest_wait_s"),
        F.max(F.when(line.contains(WALL_SEEN), seq)).alias("_seen"),
        F.max(F.when(line.contains(WALL_GONE), seq)).alias("_gone"),
        F.max_by(total, F.when(total.isNotNull(), seq)).alias("store_total"),
        F.max("ts").alias("_last"),
    )
    pending = F.col("_seen").isNotNull() & (F.col("_seen") > F.coalesce("_gone", F.lit(-1)))
    frozen = seconds_between(clock, F.col("_last")) >= frozen_s
    return out.select(
        "run_id",
        F.when(F.col("_clean"), "clean").when(F.col("_trace"), "crash").otherwise("unknown").alias("exit_kind"),
        "longest_wait_s",
        pending.alias("wall_pending"),
        "store_total",
        F.when(frozen, "frozen").when(F.col("longest_wait_s") >= waiting_s, "hang")
        .when(pending, "wall").otherwise("healthy").alias("state"),
    )


def history(events: DataFrame, n: int = 200) -> DataFrame:
    """The last ``n`` rows of each user's history."""
    return last_n(events, ["user_id"], [F.desc("ts"), F.desc("event_id")], n)


def candidates(attempts: DataFrame, park_after: int = 5, cool_s: int = 3600) -> DataFrame:
    """Pool of failed candidates: attempts, last outcome, parked or eligible now."""
    clock = attempts.agg(F.max("ts")).scalar()
    failed = F.col("outcome") != "ok"
    pool = attempts.groupBy("session_id").agg(
        F.count_if(failed).alias("attempts"),
        F.max_by("outcome", F.struct("ts", "event_id")).alias("last_outcome"),
        F.max("ts").alias("_last"),
    ).where("attempts > 0")
    fresh = seconds_between(clock, F.col("_last")) < cool_s
    promoted = F.col("last_outcome") == "ok"
    state = (
        F.when(promoted, "promoted").when(F.col("attempts") > park_after, "parked")
        .when(fresh, "cooling").otherwise("eligible")
    )
    return pool.withColumn("state", state).drop("_last")

"""Ordered computations per key that survive a key with most of the rows.

A plain window sorts a whole key in one task. Here rows are first ranked over the
whole cluster; blocks of ranks are even by construction, each block is one window,
and what earlier blocks contribute comes from a small summary with one row per key
and block:

* ``with_position``  rank of every row within its key;
* ``running``        running min / max / sum, own row included or not;
* ``rolling``        frames of the last n rows, by repeating the n-1 rows before
  each block inside it;
* ``trailing_count`` frames over a span of time, as a running sum of rows that
  enter and leave.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieproof.session import written

BLOCK = 100_000


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def join_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which a null key finds the null key; the columns of ``left``, then the others of ``right``."""
    names = {k: f"_right{i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(names)
    same = F.lit(True)
    for k, n in names.items():
        same = same & F.col(k).eqNullSafe(F.col(n))
    return left.join(right, same, how).drop(*names.values())


def _offsets(per_bucket: DataFrame, keys: list[str], bucket: str, aggs: dict[str, Column], *more: str) -> DataFrame:
    """Combine the summaries of all earlier buckets of a key; one row per key and bucket."""
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return per_bucket.select(*keys, bucket, *more, *[c.over(w).alias(n) for n, c in aggs.items()])


def with_position(df: DataFrame, keys: list[str], order: list[str], name: str = "pos", parts: int | None = None) -> DataFrame:
    """Zero-based rank of each row in the order of its key.

    All rows are dealt out by ranges of (key, order), whose bounds Spark takes
    from a sample: a burst, or many rows at one time, is cut along the later
    columns of the order. The dealt rows are written, so that their places are the
    same wherever they are read; what a key has in earlier ranges is a sum over
    one row per key and range. Rows that agree in key and whole order are ranked
    in any order. Null keys are keys too.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
    rows = written(dealt.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)))
    runs = rows.groupBy(*keys, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = _offsets(runs, keys, "_part", {"_before": F.sum("_n")}, "_first")
    pos = F.coalesce("_before", F.lit(0)) + F.col("_at") - F.col("_first")
    placed = join_safe(rows, before, [*keys, "_part"]).withColumn(name, pos.cast("long"))
    return placed.drop("_at", "_part", "_first", "_before")


def blocks(pos: str = "pos", size: int = BLOCK) -> Column:
    return F.floor(F.col(pos) / size).cast("long")


_COMBINE = {"max": (F.max, F.greatest), "min": (F.min, F.least), "sum": (F.sum, None)}


def running(
    df: DataFrame,
    keys: list[str],
    aggs: dict[str, tuple[str, Column]],
    pos: str = "pos",
    upto: int = 0,
    size: int = BLOCK,
) -> DataFrame:
    """Running aggregates over all rows of the key up to the row (``upto=-1``: before it).

    ``aggs`` maps a new column to ("max" | "min" | "sum", value); null values do not
    count. Null keys are keys too.
    """
    rows = df.withColumns({"_b": blocks(pos, size), **{"_v_" + n: v for n, (_, v) in aggs.items()}})
    totals = rows.groupBy(*keys, "_b").agg(*[_COMBINE[k][0]("_v_" + n).alias("_t_" + n) for n, (k, _) in aggs.items()])
    before = _offsets(totals, keys, "_b", {"_o_" + n: _COMBINE[k][0]("_t_" + n) for n, (k, _) in aggs.items()})
    w = Window.partitionBy(*keys, "_b").orderBy(pos).rowsBetween(Window.unboundedPreceding, upto)
    out = rows.withColumns({"_l_" + n: _COMBINE[k][0]("_v_" + n).over(w) for n, (k, _) in aggs.items()})
    out = join_safe(out, before, [*keys, "_b"])
    combined = {}
    for n, (k, _) in aggs.items():
        mine, earlier = F.col("_l_" + n), F.col("_o_" + n)
        if k == "sum":
            combined[n] = F.coalesce(mine, F.lit(0)) + F.coalesce(earlier, F.lit(0))
        else:
            combined[n] = _COMBINE[k][1](mine, earlier)
    out = out.withColumns(combined)
    return out.drop("_b", *[p + n for n in aggs for p in ("_v_", "_t_", "_l_", "_o_")])


def _with_heads(df: DataFrame, n: int, pos: str, size: int) -> DataFrame:
    """Rows by block ``_b``; the last n-1 rows of a block (``_own``) are repeated at the head of the next one."""
    if n > size:
        raise ValueError("the frame must not be longer than a block")
    own = blocks(pos, size)
    tail = F.col(pos) % size >= size - (n - 1)
    copies = F.when(tail, F.array(own, own + 1)).otherwise(F.array(own))
    return df.withColumn("_own", own).withColumn("_b", F.explode(copies))


def rolling(
    df: DataFrame, keys: list[str], n: int, aggs: dict[str, Column], pos: str = "pos", size: int = BLOCK
) -> DataFrame:
    """Aggregates over the last ``n`` rows of the key, the row itself included."""
    rows = _with_heads(df, n, pos, size)
    w = Window.partitionBy(*keys, "_b").orderBy(pos).rowsBetween(-(n - 1), 0)
    out = rows.withColumns({name: c.over(w) for name, c in aggs.items()})
    return out.where(F.col("_b") == F.col("_own")).drop("_b", "_own")


def rolling_counts(
    df: DataFrame, keys: list[str], counts: dict[str, tuple[int, Column]], pos: str = "pos", size: int = BLOCK
) -> DataFrame:
    """How many of the last n rows of the key meet a condition, for several (n, condition) in one pass.

    A count is the difference of two running sums, whatever n is.
    """
    rows = _with_heads(df, max(n for n, _ in counts.values()), pos, size)
    w = Window.partitionBy(*keys, "_b").orderBy(pos)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumns({"_c_" + name: F.count_if(met).over(upto) for name, (_, met) in counts.items()})
    out = out.withColumns({name: F.col("_c_" + name) - F.lag("_c_" + name, n, 0).over(w) for name, (n, _) in counts.items()})
    return out.where(F.col("_b") == F.col("_own")).drop("_b", "_own", *["_c_" + name for name in counts])


def trailing_count(
    df: DataFrame, keys: list[str], ts: str, seq: str, seconds: int, name: str, size: int = BLOCK
) -> DataFrame:
    """How many earlier rows of the key lie less than ``seconds`` back.

    Every row enters at its time and leaves ``seconds`` later; the count is the
    running sum of both before the row.
    """
    span = seconds * 1_000_000
    change = F.explode(F.array(
        F.struct(F.lit(True).alias("enters"), micros(ts).alias("us"), F.lit(1).alias("by")),
        F.struct(F.lit(False).alias("enters"), (micros(ts) + span).alias("us"), F.lit(-1).alias("by")),
    ))
    moves = df.withColumn("_c", change).select("*", F.col("_c.us").alias("_us"), F.col("_c.enters").alias("_enters"))
    rows = with_position(moves, keys, ["_us", "_enters", seq], "_pos")
    out = running(rows, keys, {name: ("sum", F.col("_c.by"))}, "_pos", upto=-1, size=size)
    return out.where("_enters").drop("_c", "_us", "_enters", "_pos")


def last_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The last ``n`` rows of each key; the rank filter runs before the shuffle as well."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rn).where(F.col("_rn") <= n).drop("_rn")

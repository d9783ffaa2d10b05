"""Roots and descendants in a snapshot of processes.

Parent pointers are followed by doubling: after i rounds a pointer spans 2**i
generations, so a chain of a million needs twenty joins. Each round is
checkpointed to keep the plan short and the work safe against lost executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieproof.session import shared_folder


def top_ancestors(procs: DataFrame, is_top: Column) -> DataFrame:
    """``pid`` and the first ancestor (or itself) for which ``is_top`` holds; null if none.

    ``procs`` has ``pid, ppid`` and whatever ``is_top`` reads.
    """
    shared_folder(procs.sparkSession)
    parents = procs.select(F.col("pid").alias("ppid"), F.lit(True).alias("_known"))
    state = procs.join(parents, "ppid", "left").select(
        "pid",
        F.when(is_top, F.col("pid")).when(F.col("_known"), F.col("ppid")).alias("ptr"),
        is_top.alias("done"),
    ).checkpoint()
    open_end = ~F.col("done") & F.col("ptr").isNotNull()
    # No chain is longer than the rows on it: after log2 of them only cycles are open.
    rounds = state.where(open_end).count().bit_length() + 1
    for _ in range(rounds):
        far = state.select(F.col("pid").alias("ptr"), F.col("ptr").alias("_far"), F.col("done").alias("_far_done"))
        moved = state.where(open_end).join(far, "ptr", "left").select(
            "pid", F.col("_far").alias("ptr"), F.coalesce("_far_done", F.lit(False)).alias("done")
        )
        state = state.where(~open_end).union(moved).checkpoint()
        if state.where(open_end).isEmpty():
            break
    return state.select("pid", F.when(F.col("done"), F.col("ptr")).alias("top"))


def orphans(procs: DataFrame, name: str) -> DataFrame:
    """Processes of one name under a root whose parent is gone, the roots included.

    Only chains of processes of that name count.
    """
    watched = procs.where(F.col("name") == name)
    alive = procs.select(F.col("pid").alias("ppid"), F.col("name").alias("_pname"))
    kin = watched.join(alive, "ppid", "left").withColumn("_root", F.coalesce(F.col("_pname") != name, F.lit(True)))
    kin = kin.withColumn("_orphan", F.col("_pname").isNull())
    tops = top_ancestors(kin, F.col("_root"))
    roots = kin.where("_root AND _orphan").select(F.col("pid").alias("top"))
    return tops.join(roots, "top", "left_semi").select("pid", F.col("top").alias("root"))


def descendants(procs: DataFrame, root: int, name: str) -> DataFrame:
    """Processes of one name that descend from ``root`` (itself left out)."""
    tops = top_ancestors(procs, F.col("pid") == root)
    below = tops.where((F.col("top") == root) & (F.col("pid") != root)).select("pid")
    return procs.where(F.col("name") == name).join(below, "pid", "left_semi").select("pid")

"""Mixing sources to target weights by weighted fair queueing.

Every document gets a virtual finish time: the words of its source up to and
with it, in a shuffled order, divided by the source's target. The queue of all
documents, each queued once per allowed repeat, is sorted by that time over the
whole cluster and cut at the total budget. Each source then has moved along its
own target by the same fraction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieproof.llm.tables import partitions, query, saved, table

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, repeats: int = 2) -> DataFrame:
    """``source, source_size, target``: the budget by weight, none above ``repeats`` times its source.

    ``sizes`` has one row per source. Sources by code point, null last, take the
    weights in turn. What a full source leaves is shared again by weight: sources
    in the order of capacity per weight are full as long as their capacity is
    at most their part of what the earlier ones left. One row per source, so the
    windows over all of them are small by nature.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    known = sizes.withColumn("weight", weight).withColumn("capacity", F.col("source_size") * F.lit(float(repeats)))
    everything = Window.partitionBy(F.lit(0))
    fill = Window.orderBy(F.col("capacity") / F.col("weight"), F.col("source").asc_nulls_last())
    known = known.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
    earlier = fill.rowsBetween(Window.unboundedPreceding, -1)
    on = fill.rowsBetween(0, Window.unboundedFollowing)
    known = known.withColumn("left", F.col("budget") - F.coalesce(F.sum("capacity").over(earlier), F.lit(0.0)))
    known = known.withColumn("rate", F.col("left") / F.sum("weight").over(on))
    known = known.withColumn("full", F.col("capacity") <= F.col("weight") * F.col("rate"))
    # the rate of the first source that is not full holds for all after it
    level = F.max(F.when(~F.col("full"), F.col("rate"))).over(everything)
    return known.select("source", "source_size", F.when(
        F.col("full"), F.col("capacity")).otherwise(F.col("weight") * level).alias("target"))


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The rows of ``documents`` that the mix takes, with all columns and ``mix_size``, ``mix_taken`` (words; former
    columns of these names give way).

    Rows that agree in id, source and size are taken alike.
    """
    documents = documents.drop("mix_size", "mix_taken")
    picked = mix(documents, **options).where("taken > 0").groupBy("doc_id", "source", "size").agg(F.max("taken").alias("taken"))
    picked = picked.toDF("mix_doc_id", "mix_source", "mix_size", "mix_taken")
    same = (F.col("doc_id").eqNullSafe(F.col("mix_doc_id")) & F.col("source").eqNullSafe(F.col("mix_source"))
            & (word_count(F.col("text")) == F.col("mix_size")))
    return documents.join(picked, same).select(documents["*"], "mix_size", "mix_taken")


def mix(documents: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, repeats: int = 2,
        per_slot: int = 20_000) -> DataFrame:
    """``doc_id, size, source_size, target, taken, source`` of every row of ``documents`` (``doc_id``, ``text``, ``source``).

    Size is the number of words (null text: 0), ``taken`` the words that the mix
    takes of the document: a whole number of times its size, ``repeats`` at most.
    A null source is a source of its own, last in the order of names. Documents of
    a source are shuffled by a hash of the id, ties by id, then size; repeated
    rows are documents of their own. With nothing to take, all is 0.

    Running sums are built from slots: ranges of the whole order with about
    ``per_slot`` rows each, at least as many as shuffle partitions. Repeated rows
    and rows without an id are told apart by a row number, so a source or an id
    that most rows have is summed by many tasks; as such rows are alike, which of
    them comes first changes nothing.
    """
    spark = documents.sparkSession
    order = F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit("mix"))
    docs = saved(documents.select("doc_id", "source", word_count(F.col("text")).alias("size")).withColumn(
        "order", order).withColumn("row", F.monotonically_increasing_id()))
    sizes = saved(docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")))
    slots = max(partitions(spark), -(-(sizes.agg(F.sum("n")).first()[0] or 0) // per_slot))
    goals = saved(targets(sizes.drop("n"), weights, share, repeats)).withColumnRenamed("source", "name")

    ahead = ["order", "doc_id", "size", "row"]
    docs = saved(docs.repartitionByRange(slots, "source", *ahead).withColumn("slot", F.spark_partition_id()))
    in_slot = Window.partitionBy("source", "slot").orderBy(*ahead).rowsBetween(Window.unboundedPreceding, 0)
    sums = docs.groupBy("source", "slot").agg(F.sum("size").alias("slot_size"))
    before = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("slot").alias("k"),
                       F.coalesce(F.sum("slot_size").over(before), F.lit(0)).alias("offset"))
    timed = docs.withColumn("run", F.sum("size").over(in_slot)).join(
        sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("slot") == F.col("k"))).join(
        goals, F.col("source").eqNullSafe(F.col("name")))
    # finish time of the first passage; that of each repeat lies one source size further on
    timed = saved(timed.select("doc_id", "size", "source_size", "target", "order", "source",
                               (F.col("offset") + F.col("run")).alias("position")))
    finish = lambda again: (F.col("position") + again * F.col("source_size")) / F.col("target")
    queue = timed.where("size > 0 AND target > 0").select(
        "size", "order", "doc_id", F.posexplode(F.array(*[finish(k) for k in range(repeats)])).alias("again", "finish"))
    line = ["finish", "order", "doc_id", "again"]
    ranged = saved(queue.repartitionByRange(partitions(spark), *line).withColumn("part", F.spark_partition_id()))
    budget = share * (sizes.agg(F.sum("source_size")).first()[0] or 0)
    parts = ranged.groupBy("part").agg(F.sum("size").alias("part_size"))
    parts = parts.withColumn("upto", F.sum("part_size").over(Window.orderBy("part")))
    cut = parts.where(F.col("upto") >= budget).orderBy("part").limit(1)
    last = cut.first()
    if last is None:
        taken = F.col("size") * repeats
    else:
        inside = Window.partitionBy("part").orderBy(*line)
        edge = ranged.where(F.col("part") == last["part"]).withColumn(
            "upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) + (last["upto"] - last["part_size"])
        ).where(F.col("upto") >= budget).orderBy(*line).limit(1).first()
        key = F.struct(*[F.lit(edge[c]).alias(c) for c in line])
        mine = lambda k: F.struct(finish(k).alias("finish"), F.col("order"), F.col("doc_id"), F.lit(k).alias("again"))
        taken = sum((F.when(mine(k) <= key, F.col("size")).otherwise(0) for k in range(repeats)), F.lit(0))
    taken = F.when((F.col("size") > 0) & (F.col("target") > 0), taken).otherwise(0).cast("long")
    return timed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "source")


@query("op4_mix_sources")
def op4_mix_sources(spark, folder):
    return mix(table(spark, folder, "documents", "doc_id", "text", "source"))

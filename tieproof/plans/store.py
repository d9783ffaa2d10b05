"""The record store and the batches merged into it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieproof.config import Config
from tieproof.functions import rules
from tieproof.functions.text import is_blank
from tieproof.operators.merge import admitted, backfill_founder, conflicts, merge_fields
from tieproof.session import spread, written

C = F.col


def source_rows(df: DataFrame) -> DataFrame:
    """Distinct (name_key, source_url)."""
    return df.where(~is_blank(C("source_url"))).select("name_key", "source_url").distinct()


def prepared(batch: DataFrame, cfg: Config) -> DataFrame:
    """Rows of a batch that the store accepts, with typed fields; written, since the merge reads them several times.

    Records in the nested layout (with ``people``) get their flat founder fields first.
    """
    if "people" in batch.columns:
        batch = backfill_founder(batch)
    return written(rules.coerce(admitted(spread(batch, "rec_seq"), cfg)))


def upsert(
    store: DataFrame | None, sources: DataFrame | None, batch: DataFrame, cfg: Config
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New store, new source rows and the conflicts of the batch."""
    return merged_with(store, sources, prepared(batch, cfg), cfg)


def merged_with(
    store: DataFrame | None, sources: DataFrame | None, new: DataFrame, cfg: Config
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """:func:`upsert` of ``prepared`` rows.

    Stored values come first in the order of preference, batch rows follow in
    the order of ``rec_seq``. The list of sources of a record stays a table of
    rows; the store carries its size.
    """
    both = new = new.withColumn("_from", F.lit(1))
    rows = source_rows(new)
    if store is not None:
        both = store.withColumn("_from", F.lit(0)).unionByName(new, allowMissingColumns=True)
        rows = sources.union(rows).distinct()
    ordered = both.withColumn("_order", F.shiftleft(C("_from").cast("long"), 60) + C("rec_seq"))
    merged = merge_fields(ordered, "_order").drop("n_merged")
    counts = rows.groupBy("name_key").agg(F.count("*").alias("n_sources"))
    merged = merged.join(counts, "name_key", "left").withColumns({
        "n_sources": F.coalesce("n_sources", F.lit(0)),
        "rec_seq": C("_order").bitwiseAND(F.lit((1 << 60) - 1)),
    }).drop("_order")
    merged = merged.withColumn("verified", C("verified") | (C("n_sources") >= 2))
    return rules.validate(merged, cfg), rows, conflicts(ordered, order="_order")

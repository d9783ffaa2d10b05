"""List unions and set differences, kept as rows so that no list outgrows a task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieproof.functions.text import text


def union_values(df: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """Ordered union of lists without repeats and empties: key, value, first position."""
    return df.where(text(F.col(value)) != "").groupBy(key, F.col(value).alias("value")).agg(F.min(pos).alias(pos))


def union_by_name(df: DataFrame, key: str, name: str, pos: str, fields: list[str]) -> DataFrame:
    """Union of entries by name, the first entry wins."""
    first = F.min(F.struct(pos, *fields)).alias("_f")
    return df.where(text(F.col(name)) != "").groupBy(key, name).agg(first).select(key, name, "_f.*")


def both_or_only(df: DataFrame, key: str, a: str, b: str, only: tuple[str, str]) -> DataFrame:
    """Which of two flags hold anywhere under a key: 'both', or one of the two names."""
    flags = df.groupBy(key).agg(F.max(a).alias("_a"), F.max(b).alias("_b")).where("_a OR _b")
    kind = F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), only[0]).otherwise(only[1])
    return flags.select(key, kind.alias("kind"))

"""What the operators share: the registry of their queries, input columns, folders and partition counts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tieproof.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` under ``name``; ``sql`` says the same for another engine."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def saved(df: DataFrame, light: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Later steps read it more than once, and an executor that is lost takes
    nothing of it along. ``light`` rows, ids and counts, are written by an eighth
    of the tasks that a shuffle has.
    """
    spark = df.sparkSession
    if light:
        df = df.coalesce(max(1, partitions(spark) // 8))
    path = f"{shared_folder(spark)}/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``: the fold of a labelled row."""
    return F.crc32(key.cast("string").cast("binary")) % modulus

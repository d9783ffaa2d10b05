"""Running a stream over what is there now, with its sink in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieproof.session import scratch


def follow(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Files of a folder (or glob) as a stream; new files make new micro-batches."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def drain_to_table(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Process all available input into a Parquet table and read that back."""
    spark = stream.sparkSession
    base = scratch(spark)
    query = (
        stream.writeStream.format("parquet").outputMode(mode)
        .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(f"{base}/table")
    )
    query.awaitTermination()
    return spark.read.parquet(f"{base}/table")


def drain_each_batch(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None
) -> None:
    """Hand every micro-batch of the available input to ``handle(batch, batch_id)``."""
    base = checkpoint or f"{scratch(stream.sparkSession)}/checkpoint"
    query = (
        stream.writeStream.foreachBatch(handle).outputMode(mode)
        .option("checkpointLocation", base).trigger(availableNow=True).start()
    )
    query.awaitTermination()


class LogSink:
    """Micro-batches kept as a log, one folder per batch, so that a repeated batch replaces its first try.

    ``each`` reduces a batch before it is kept. What is read back does not depend on
    how rows were split into batches, nor on their order.
    """

    def __init__(self, path: str, each: Callable[[DataFrame], DataFrame] = lambda batch: batch):
        self.path, self.each = path, each

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.each(batch).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def log(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop("batch_id")


def drain_to_log(stream: DataFrame, each: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> DataFrame:
    """All available input as a log in the shared folder."""
    sink = LogSink(scratch(stream.sparkSession), each)
    drain_each_batch(stream, sink)
    return sink.log(stream.sparkSession)


def drain_updates(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Updates of a running aggregate collected into a table: the latest row per key."""
    spark, path = stream.sparkSession, scratch(stream.sparkSession)

    def handle(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch, so that a repeated batch replaces its first try.
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    drain_each_batch(stream, handle, mode="update")
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in (*keys, "batch_id")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_r")).select(*keys, "_r.*")

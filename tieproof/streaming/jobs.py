"""Streams over append-only logs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tieproof.config import Config
from tieproof.operators.logs import STORE_TOTAL, WAITING, WALL_GONE, WALL_SEEN
from tieproof.operators.stats import CALL_OUTCOMES
from tieproof.plans import store as store_plan

C = F.col
EPOCH_ROUNDS = 20
# Ways to fetch a page.
FETCH_PATHS = ("cache", "http", "browser")


def visits_of(visits: DataFrame) -> DataFrame:
    """``url, epoch`` of a batch of visits, once each; an epoch is twenty rounds."""
    return visits.select("url", F.floor(C("round") / EPOCH_ROUNDS).cast("int").alias("epoch")).distinct()


def visited(log: DataFrame) -> DataFrame:
    """First visits over all batches of ``visits_of``, however late they came."""
    return log.select("url", "epoch").distinct()


def call_sums(calls: DataFrame) -> DataFrame:
    """Sums per day of a batch of calls."""
    return calls.groupBy(C("ts").cast("date").alias("day")).agg(
        F.count("*").alias("calls"),
        *[F.count_if(C("outcome") == o).alias(o) for o in CALL_OUTCOMES],
        F.sum("latency_ms").alias("latency_ms"),
    )


def fetch_sums(fetches: DataFrame) -> DataFrame:
    """Sums per day of a batch of fetches, by path and outcome."""
    return fetches.groupBy(C("ts").cast("date").alias("day")).agg(
        F.count("*").alias("fetches"),
        *[F.count_if(C("path") == p).alias(f"path_{p}") for p in FETCH_PATHS],
        F.count_if(C("outcome") == "ok").alias("fetch_ok"),
    )


def round_metrics(calls: DataFrame, fetches: DataFrame) -> DataFrame:
    """Metrics per day from the sums of all batches; a late row adds to its day like any other."""
    add = lambda df: df.groupBy("day").agg(*[F.sum(c).alias(c) for c in df.columns if c != "day"])
    both = add(calls).join(add(fetches), "day", "full")
    counts = ["calls", *CALL_OUTCOMES, "fetches", *[f"path_{p}" for p in FETCH_PATHS], "fetch_ok"]
    return both.select(
        "day", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.expr("latency_ms div greatest(calls, 1)").alias("avg_latency_ms"),
        F.when(C("fetches") > 0, F.round(C("fetch_ok") / C("fetches"), 3)).alias("fetch_ok_rate"),
    )


def watch(lines: DataFrame) -> DataFrame:
    """Running state of each run: longest wait, pending wall, last total."""
    line, seq = C("line"), C("seq")
    total = F.regexp_extract(line, STORE_TOTAL, 1).try_cast("long")
    return lines.groupBy("run_id").agg(
        F.coalesce(F.max(F.regexp_extract(line, WAITING, 1).try_cast("long")), F.lit(0)).alias("longest_wait_s"),
        F.coalesce(F.max(F.when(line.contains(WALL_SEEN), seq)), F.lit(-1)).alias("seen"),
        F.coalesce(F.max(F.when(line.contains(WALL_GONE), seq)), F.lit(-1)).alias("gone"),
        F.max_by(total, F.when(total.isNotNull(), seq)).alias("store_total"),
    ).select("run_id", "longest_wait_s", (C("seen") > C("gone")).alias("wall_pending"), "store_total")


class StoreSink:
    """Merges micro-batches into a store in hash buckets; a batch rewrites the buckets that it touches and no others.

    A manifest per batch says in which version each bucket is. A batch starts from
    the manifest of the last batch before it, whatever its number, writes its
    buckets under its own number and its manifest last; so a batch that is replayed
    after a failure starts from the same rows again, and readers see the store
    before it or after it. Versions that no manifest needs any more may be deleted.
    """

    def __init__(self, path: str, cfg: Config, buckets: int = 64):
        self.path, self.cfg, self.buckets = path, cfg, buckets

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def manifest(self, spark: SparkSession, before: int | None = None) -> dict[int, int]:
        """Version of each bucket after the last batch (before the one given); one row a bucket, so a small list."""
        try:
            rows = spark.read.schema("bucket int, version long, batch_id long").parquet(f"{self.path}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        rows = rows if before is None else rows.where(C("batch_id") < before)
        last = rows.agg(F.max("batch_id")).first()[0]
        return {r["bucket"]: r["version"] for r in rows.where(C("batch_id") == F.lit(last)).collect()}

    def _read(self, spark: SparkSession, name: str, versions: dict[int, int], schema: str | None = None) -> DataFrame | None:
        out = None
        for version in sorted(set(versions.values())):
            reader = spark.read if schema is None else spark.read.schema(schema)
            rows = reader.parquet(f"{self.path}/{name}/version={version}").where(
                C("bucket").isin([b for b, v in versions.items() if v == version])).drop("bucket")
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
        return out

    def _write(self, df: DataFrame, name: str, batch_id: int) -> None:
        df = df.withColumn("bucket", self.bucket(C("name_key"))).repartition("bucket")
        df.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}/version={batch_id}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        versions = self.manifest(spark, batch_id)
        new = store_plan.prepared(batch, self.cfg)
        touched = {r[0] for r in new.select(self.bucket(C("name_key"))).distinct().collect()}
        if touched:
            mine = {b: v for b, v in versions.items() if b in touched}
            old = self._read(spark, "store", mine)
            sources = self._read(spark, "sources", mine, "name_key string, source_url string, bucket int")
            if old is not None:
                old = old.drop("validation_tier", "validation_issues")
            merged, rows, clash = store_plan.merged_with(old, sources, new, self.cfg)
            clash.write.mode("overwrite").parquet(f"{self.path}/conflicts/batch_id={batch_id}")
            self._write(rows, "sources", batch_id)
            self._write(merged, "store", batch_id)
        after = list({**versions, **dict.fromkeys(touched, batch_id)}.items())
        listed = spark.createDataFrame(after, "bucket int, version long")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/batch_id={batch_id}")

    def conflicts(self, spark: SparkSession) -> DataFrame:
        """Conflicts of each batch."""
        return spark.read.parquet(f"{self.path}/conflicts")

    def result(self, spark: SparkSession) -> DataFrame:
        """The store after the last finished batch."""
        return self._read(spark, "store", self.manifest(spark))

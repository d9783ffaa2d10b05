"""Reports over the record set and the logs. All of them are partial aggregations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieproof.functions import rules
from tieproof.functions.text import is_blank, text

# Outcomes of a model call.
CALL_OUTCOMES = (
    "parsed", "fence_extracted", "marker_sliced", "prompt_echoed", "empty",
    "timeout", "crash", "schema_invalid", "evidence_unverified",
)


def distribution(df: DataFrame, *fields: str) -> DataFrame:
    """Counts of every value of several fields in one pass: field, value, n."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]))
    return df.select(pairs.alias("_p")).groupBy("_p.field", "_p.value").agg(F.count("*").alias("n"))


def totals(df: DataFrame) -> DataFrame:
    """Record, public, acquired and funded counts, total and floor mean of the funding; zero is undisclosed."""
    amount = F.when(F.col("funding_total_usd") != 0, F.col("funding_total_usd"))
    sums = df.agg(
        F.count("*").alias("n_records"),
        F.count_if(F.col("status") == "ipo").alias("n_public"),
        F.count_if(F.col("status") == "acquired").alias("n_acquired"),
        F.count(amount).alias("n_funded"),
        F.coalesce(F.sum(amount), F.lit(0)).cast("long").alias("total_funding"),
    )
    mean = F.when(F.col("n_funded") > 0, F.floor(F.expr("total_funding div n_funded"))).otherwise(0)
    return sums.withColumn("mean_funding", mean.cast("long"))


def decades(df: DataFrame) -> DataFrame:
    year = F.col("founded_year")
    return (
        df.where(year.between(1900, 2030))
        .groupBy((F.floor(year / 10) * 10).cast("int").alias("decade"))
        .agg(F.count("*").alias("n"))
    )


def top_counts(df: DataFrame, field: str, n: int) -> DataFrame:
    """Most frequent non-empty values; ties by value."""
    return (
        df.where(text(F.col(field)) != "").groupBy(field).agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), field).limit(n)
    )


def gap_flags(df: DataFrame) -> DataFrame:
    """One flag column per kind of gap."""
    return df.withColumns({
        "no_founder": rules.missing_founder(F.col("founder"), F.col("affiliation_type")),
        "no_proof": rules.missing_text(F.col("proof_url")),
        "no_description": rules.missing_text(F.col("description")),
        "unverified": ~F.coalesce(F.col("verified"), F.lit(False)),
    })


def gap_counts(df: DataFrame) -> DataFrame:
    """Totals per gap; a record is complete when none of the three required parts is missing."""
    f = gap_flags(df)
    missing = F.col("no_founder") | F.col("no_proof") | F.col("no_description")
    return f.agg(
        F.count("*").alias("total"),
        F.count_if("no_founder").alias("missing_founders"),
        F.count_if("no_proof").alias("missing_proof_url"),
        F.count_if("no_description").alias("missing_description"),
        F.count_if("unverified").alias("unverified"),
        (F.count("*") - F.count_distinct(F.when(missing, F.col("company_name")))).alias("complete_count"),
    )


def gap_names(df: DataFrame) -> DataFrame:
    """The names behind the counts, one row per gap and record."""
    kinds = F.filter(
        F.array(*[
            F.when(F.col(c), F.lit(k)) for c, k in (
                ("no_founder", "missing_founders"), ("no_proof", "missing_proof_url"),
                ("no_description", "missing_description"), ("unverified", "unverified"),
            )
        ]),
        lambda k: k.isNotNull(),
    )
    return gap_flags(df).select("rec_seq", "company_name", F.explode(kinds).alias("gap"))


def gap_targets(df: DataFrame, n: int = 15) -> DataFrame:
    """Records to fill next: both parts missing, then founder only, then url only."""
    f = gap_flags(df)
    priority = (
        F.when(F.col("no_founder") & F.col("no_proof"), 1).when(F.col("no_founder"), 2).when(F.col("no_proof"), 3)
    )
    names = f.withColumn("priority", priority).where(F.col("priority").isNotNull())
    return (
        names.groupBy("company_name").agg(F.min("priority").alias("priority"))
        .orderBy("priority", "company_name").limit(n)
    )


def suspicion(df: DataFrame, n: int = 20) -> DataFrame:
    """Unverified records without evidence, most missing fields first."""
    missing: list[Column] = [
        is_blank(F.col("founders")) | (F.col("founders") == "Unknown"),
        is_blank(F.col("proof_url")),
        is_blank(F.col("description")),
    ]
    score = reduce(lambda a, b: a + b, [m.cast("int") for m in missing])
    return (
        df.where(~F.coalesce(F.col("verified"), F.lit(False)) & is_blank(F.col("evidence")))
        .select("rec_seq", "company_name", score.alias("score"))
        .orderBy(F.desc("score"), "rec_seq").limit(n)
    )


def summary(df: DataFrame, top: int = 15) -> DataFrame:
    """Counts by industry (the most frequent), kind of tie and status, with Unknown for nothing."""
    named = {
        f: F.when(text(F.col(f)) == "", "Unknown").otherwise(F.col(f)) for f in ("industry", "affiliation_type", "status")
    }
    counts = distribution(df.select(*[c.alias(n) for n, c in named.items()]), *named)
    industries = counts.where("field = 'industry'").orderBy(F.desc("n"), "value").limit(top)
    return industries.union(counts.where("field <> 'industry'"))


def round_metrics(calls: DataFrame, fetches: DataFrame) -> DataFrame:
    """Per round: calls by outcome, floor mean latency, share parsed; fetches and share empty."""
    c = calls.groupBy("round").agg(
        F.count("*").alias("calls"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in CALL_OUTCOMES],
        F.sum("latency_ms").alias("_latency"),
    )
    f = fetches.groupBy("round").agg(
        F.count("*").alias("fetches"), F.count_if(F.col("outcome") == "empty").alias("empty_fetches")
    )
    return (
        c.join(f, "round", "full")
        .withColumns({
            "avg_latency_ms": F.expr("_latency div greatest(calls, 1)"),
            "parsed_pct": F.when(F.col("calls") > 0, F.bround(F.lit(100.0) * F.col("parsed") / F.col("calls"))).otherwise(0.0),
            "empty_pct": F.when(
                F.col("fetches") > 0, F.round(F.lit(100.0) * F.col("empty_fetches") / F.col("fetches"), 1)
            ).otherwise(0.0),
        })
        .drop("_latency")
    )


def bucket_percent(df: DataFrame, order=rules.TRIAGE_ORDER) -> DataFrame:
    """Counts and whole percent per bucket, in report order."""
    rank = F.array_position(F.array(*[F.lit(b) for b in order]), F.col("bucket"))
    counts = df.groupBy("bucket").agg(F.count("*").alias("n"))
    return counts.withColumns({
        "pct": F.floor(F.col("n") * 100 / df.agg(F.count("*")).scalar()).cast("long"),
        "position": rank.cast("int"),
    }).orderBy("position")


def span_rates(claims: DataFrame, matched: Column, variant: str, record: str) -> DataFrame:
    """Per variant: records, survived, dropped and mean share of matched spans."""
    per_record = claims.groupBy(variant, record).agg(
        F.count("*").alias("_n"), F.count_if(matched).alias("_good")
    )
    return per_record.groupBy(variant).agg(
        F.count("*").alias("n_records"),
        F.count_if(F.col("_good") > 0).alias("survived"),
        F.count_if(F.col("_good") == 0).alias("dropped"),
        F.round(F.avg(F.col("_good") / F.greatest("_n", F.lit(1))), 3).alias("avg_match"),
    )


def tier_shift(df: DataFrame, before: str, after: str) -> DataFrame:
    """Counts per tier before and after revalidation, and how many changed to it."""
    pairs = df.groupBy(F.col(before).alias("b"), F.col(after).alias("a")).agg(F.count("*").alias("n"))
    sides = pairs.select(
        F.explode(F.array(
            F.struct(F.col("b").alias("tier"), F.col("n").alias("before"), F.lit(0).cast("long").alias("after"),
                     F.lit(0).cast("long").alias("changed_to")),
            F.struct(F.col("a").alias("tier"), F.lit(0).cast("long").alias("before"), F.col("n").alias("after"),
                     F.when(F.col("a") != F.col("b"), F.col("n")).otherwise(F.lit(0)).cast("long").alias("changed_to")),
        )).alias("_s")
    ).select("_s.*")
    return sides.groupBy("tier").agg(
        *[F.sum(c).alias(c) for c in ("before", "after", "changed_to")]
    )


def engine_health(fetches: DataFrame, last: int = 50) -> DataFrame:
    """Success rate and latency percentiles of each path over its last calls.

    The rank filter runs on the map side too, so a path with most of the rows
    ships ``last`` rows per task.
    """
    rn = F.row_number().over(Window.partitionBy("path").orderBy(F.desc("ts"), F.desc("event_id")))
    recent = fetches.withColumn("_rn", rn).where(F.col("_rn") <= last)
    return recent.groupBy("path").agg(
        F.count("*").alias("n"),
        F.round(F.avg((F.col("outcome") == "ok").cast("double")), 3).alias("success_rate"),
        F.round(F.expr("percentile(latency_ms, 0.5)"), 3).alias("p50"),
        F.round(F.expr("percentile(latency_ms, 0.95)"), 3).alias("p95"),
    )

"""Outputs: published store versions, flat tables, graph files, logs by state."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieproof.functions.text import cut, text
from tieproof.functions.typing import bool3, yes_no_unknown
from tieproof.functions.urls import url_key

C = F.col

# Columns of the full export and the fields behind them.
FULL_COLUMNS = {
    "Company Name": "company_name", "Founder": "founder", "All Founders": "founders", "Description": "description",
    "Proof URL": "proof_url", "Website URL": "website_url", "LinkedIn URL": "linkedin_url",
    "Affiliation Type": "affiliation_type", "Affiliation Evidence": "evidence", "School": "school",
    "Grad Year": "grad_year", "Industry": "industry", "Status": "status", "Founded Year": "founded_year",
    "Funding Total (USD)": "funding_total_usd", "Funding Stage": "funding_stage",
    "Last Round Year": "funding_last_round_year", "Last Round Amount (USD)": "last_round_amount_usd",
    "Lead Investors": "lead_investors", "Valuation (USD)": "valuation_usd", "Employee Count": "employee_count",
    "Public Company": "is_public", "HQ": "headquarters", "Exit Year": "exit_year",
    "Exit Value (USD)": "exit_value_usd", "Acquirer": "acquirer", "Source URL": "source_url",
    "Source Credibility": "source_credibility", "Verified": "verified", "Validation Tier": "validation_tier",
    "Validation Issues": "validation_issues", "Notes": "notes",
}
# Company columns of the spreadsheet export that come straight from the record.
COMPANY_COLUMNS = (
    "company_name", "validation_tier", "status", "founded_year", "exit_year", "acquirer",
    "acquisition_amount_usd", "funding_total_usd", "funding_stage", "funding_last_round_year",
    "employee_count", "is_public", "industry", "headquarters", "tags", "website_url", "wikipedia_url",
    "linkedin_company_url", "crunchbase_url", "proof_url", "description",
)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, one file per task."""
    df.write.mode("overwrite").json(path)


def publish(df: DataFrame, path: str, version: int | None = None) -> int:
    """Write a new version beside the old ones, then make it current.

    Versions are counted; readers follow the highest that the manifest lists, so
    they see the old version or the new one and never a part. A failed write
    leaves a folder nobody points to, and a version that two writers took at the
    same time fails for the second, whose folder exists already.
    """
    spark = df.sparkSession
    if version is None:
        version = 1 + max((r["version"] for r in versions(spark, path)), default=-1)
    df.write.mode("error").parquet(f"{path}/{version}")
    spark.range(version, version + 1).withColumnRenamed("id", "version").coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return version


def versions(spark: SparkSession, path: str) -> list:
    """The published versions; none before the first."""
    try:
        return spark.read.schema("version long").parquet(f"{path}/manifest").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def current(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a published table."""
    return spark.read.parquet(f"{path}/{max(r['version'] for r in versions(spark, path))}")


def full_export(df: DataFrame) -> DataFrame:
    """The 32 columns of the full export; fields a table lacks are empty."""
    have = dict(df.dtypes)

    def cell(field: str):
        if field not in have:
            return F.lit("Unknown") if field == "is_public" else F.lit("")
        c = C(field)
        if field == "is_public":
            return yes_no_unknown(c if have[field] == "boolean" else bool3(c))
        if field == "verified":
            return F.when(c, "Yes").otherwise("No")
        if have[field].startswith("array"):
            return F.array_join(c, "; ")
        return text(c)

    return df.select(*[cell(f).alias(n) for n, f in FULL_COLUMNS.items()])


def write_full_csv(df: DataFrame, path: str) -> None:
    """Sorted by lower-case name: a range partitioning, each task sorts its own range."""
    full_export(df.orderBy(F.lower("company_name"), "rec_seq")).write.mode("overwrite").csv(path, header=True, escape='"')


def companies_flat(records: DataFrame, people: DataFrame) -> DataFrame:
    """The company columns with each of its people: one row per company and person, and one for a company without.

    ``schools`` (distinct, a short list by nature) and ``member_count`` are those of the
    whole company in each of its rows. People stay rows, so a company of any size is no
    cell of its own. Columns that ``records`` lacks are empty. ``people``: ``company, pos, person, school``.
    """
    total = people.groupBy("company").agg(
        F.count("*").alias("member_count"),
        F.array_join(F.array_sort(F.collect_set(F.when(text(C("school")) != "", C("school")))), "; ").alias("schools"),
    )
    left = records.select(*[C(c) if c in records.columns else F.lit(None).cast("string").alias(c) for c in COMPANY_COLUMNS])
    left = left.withColumnRenamed("company_name", "company").join(total, "company", "left")
    named = people.where(text(C("person")) != "").select("company", "pos", C("person").alias("name"))
    return left.withColumns({
        "member_count": F.coalesce("member_count", F.lit(0)), "schools": F.coalesce("schools", F.lit("")),
    }).join(named, "company", "left")


def edges_long(records: DataFrame, people: DataFrame, max_chars: int | None = None) -> DataFrame:
    """One row per person and company with the whole evidence, or its first ``max_chars``."""
    attrs = records.select(
        C("company_name").alias("company"), C("validation_tier").alias("company_tier"),
        C("status").alias("company_status"), C("funding_total_usd").alias("company_funding_usd"),
    )
    return people.join(attrs, "company", "left").withColumn("evidence_span", cut(text(C("evidence_span")), max_chars))


def write_graph(tables: dict[str, DataFrame], path: str) -> list[str]:
    """CSV folders of the graph; an empty table leaves none. Returns the names written.

    What is written tells whether it is empty, so no table is computed twice.
    """
    written = []
    for name, df in tables.items():
        df.write.mode("overwrite").csv(f"{path}/{name}", header=True)
        if not df.sparkSession.read.schema(df.schema).csv(f"{path}/{name}", header=True).isEmpty():
            written.append(name)
    return written


def write_by_state(df: DataFrame, path: str) -> None:
    """One folder per decision state; within it the most confident rows first per file."""
    df.sortWithinPartitions("state", F.desc("confidence")).write.mode("overwrite").partitionBy("state").parquet(path)


def write_failures(df: DataFrame, path: str) -> None:
    """Append to one failure log per status."""
    df.write.mode("append").partitionBy("status").json(path)


def cache_pages(fetched: DataFrame) -> DataFrame:
    """Page cache rows: file key, url, latest capture and its text; of captures at one time the greatest text."""
    return fetched.groupBy("url").agg(
        F.max(F.struct("captured_at", "text")).alias("_p")
    ).select(url_key(C("url")).alias("url_key"), "url", "_p.*")

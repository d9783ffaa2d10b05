"""Texts cut, numbered and packed for a model, and decisions read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieproof.functions.replies import code_tokens
from tieproof.functions.text import text
from tieproof.operators.ordered import with_position


def chunk(df: DataFrame, col: str, size: int, overlap: int, most: int | None = None) -> DataFrame:
    """Windows of ``size`` characters every ``size - overlap``; one when the text fits.

    The last window may lie inside the overlap. ``most`` caps the number per
    text; by default the whole text is covered.
    """
    step = max(size - overlap, 1)
    n = F.length(col)
    starts = F.when(n <= size, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), n - 1, F.lit(step)))
    if most is not None:
        starts = F.slice(starts, 1, most)
    cut = df.select("*", F.posexplode(starts).alias("chunk_no", "_at"))
    return cut.withColumn("chunk", F.substr(F.col(col), F.col("_at") + 1, F.lit(size))).drop("_at")


def request_parts(df: DataFrame, col: str, overhead: int, cap: int, reserve: int = 500) -> DataFrame:
    """Page text cut so that a request of ``overhead`` more characters stays under ``cap``.

    Part 0 is the trimmed text of the first request; what does not fit follows
    in further parts, so that nothing of a page is lost.
    """
    budget = cap - overhead - reserve
    n = F.length(col)
    starts = F.when(n + overhead <= cap, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), n - 1, F.lit(budget)))
    cut = df.select("*", F.posexplode(starts).alias("part", "_at"))
    width = F.when(n + overhead <= cap, n).otherwise(budget)
    return cut.withColumn("request_text", F.substr(F.col(col), F.col("_at") + 1, width)).drop("_at")


def batch_requests(df: DataFrame, key: str, fields: dict[str, Column], batch: int = 20) -> DataFrame:
    """One request text per ``batch`` rows in key order: a JSON line per row.

    Rows are numbered range by range, so no task sees the whole table; a batch is
    the only thing collected.
    """
    picked = df.select(key, *[c.alias("_f_" + n) for n, c in fields.items()])
    rows = with_position(picked, [], [key])
    line = F.to_json(
        F.struct((F.col("pos") % batch).alias("idx"), *[F.col("_f_" + n).alias(n) for n in fields]),
        {"ignoreNullFields": "false"},
    )
    packed = rows.groupBy(F.floor(F.col("pos") / batch).cast("long").alias("batch_no")).agg(
        F.count("*").alias("n_rows"),
        F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))).alias("_l"),
    )
    return packed.select(
        "batch_no", "n_rows", F.array_join(F.transform("_l", lambda x: x["line"]), "\n").alias("request")
    )


def batch_verdicts(df: DataFrame, key: str, reply: str, n_rows: Column) -> DataFrame:
    """Verdict of every row of a batch from the ``idx:CODE`` reply; missing ones are UNCLEAR."""
    tokens = df.select(key, n_rows.alias("_n"), code_tokens(F.col(reply)).alias("_t"))
    rows = tokens.select(key, "_t", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("idx"))
    mine = F.filter("_t", lambda x: x["idx"] == F.col("idx"))
    return rows.select(key, "idx", F.coalesce(F.get(mine, F.size(mine) - 1)["verdict"], F.lit("UNCLEAR")).alias("verdict"))


DECISIONS = "decisions array<struct<company_name:string,verdict:string,reason:string>>"


def names_to_remove(df: DataFrame, reply: str) -> DataFrame:
    """Names a keep / remove reply wants removed, one row each."""
    parsed = df.select("*", F.explode(F.from_json(reply, DECISIONS)["decisions"]).alias("_d"))
    return parsed.where((F.lower(text(F.col("_d.verdict"))) == "remove") & (text(F.col("_d.company_name")) != "")).select(
        *df.columns, F.col("_d.company_name").alias("company_name"), F.col("_d.reason").alias("reason")
    )


# Fields of the second request, and when they are asked.
ACQUIRED_FIELDS = ("exit_year", "acquirer", "acquisition_amount_usd")
FUNDED_FIELDS = ("funding_stage", "funding_last_round_year")
ALWAYS_FIELDS = (
    "description", "industry", "tags", "headquarters", "website_url", "linkedin_company_url",
    "crunchbase_url", "employee_count", "founded_year",
)


def fields_to_ask(status: Column, funding: Column, n_people: Column) -> Column:
    """Fields worth asking for, given what the record already says."""
    asked = [F.when(status == "acquired", F.lit(f)) for f in ACQUIRED_FIELDS]
    asked += [F.when(funding > 0, F.lit(f)) for f in FUNDED_FIELDS]
    asked.append(F.when(n_people > 1, F.lit("cofounder_schools")))
    asked += [F.lit(f) for f in ALWAYS_FIELDS]
    return F.filter(F.array(*asked), lambda f: f.isNotNull())

"""Readers of the file layouts records, logs, pages and lookup replies arrive in.

Each reader is a plain Spark read followed by a parse function on the content,
so the same parse serves files, tables and streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tieproof.functions.names import name_key
from tieproof.functions.text import strip, text
from tieproof.operators.ordered import running, with_position
from tieproof.session import written

C = F.col


def latest_records(rows: DataFrame) -> DataFrame:
    """Of records ``doc_no, pos, _r`` the last one under each store key; records without a key go."""
    rows = rows.withColumn("name_key", name_key(C("_r.company_name"))).where("name_key <> ''")
    return rows.groupBy("name_key").agg(F.max_by("_r", F.struct("doc_no", "pos")).alias("_r")).select("name_key", "_r.*")


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """``doc_no, pos, json``: the records of JSON documents, whatever their size, as texts in their order.

    A document is a list, an object with ``records`` as its first field, or an
    object keyed by name. It is read in pieces that end at a brace, by as many tasks as it has
    splits. Whether a piece begins inside a string, and how deep, is a running sum
    over the pieces before it; where the depth falls back to that of the list a
    record ends. So no task holds more of a document than its splits.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        C("_metadata.file_path").alias("doc_no"), C("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"), "value")
    pieces = with_position(pieces, ["doc_no"], ["_block", "_line"]).drop("_block", "_line")
    plain = F.regexp_replace("value", r"(?s)\\.", "__")
    pieces = pieces.withColumn("_plain", plain).withColumn("_quotes", F.length("_plain") - F.length(F.replace("_plain", F.lit('"'))))
    pieces = running(pieces, ["doc_no"], {"_before": ("sum", C("_quotes"))}, upto=-1)
    starts_inside, ends_inside = C("_before") % 2 == 1, (C("_before") + C("_quotes")) % 2 == 1
    outside = F.regexp_replace(F.concat(F.when(starts_inside, '"').otherwise(""), C("_plain")), r'(?s)"[^"]*("|$)', "")
    count = lambda c: F.length(outside) - F.length(F.replace(outside, F.lit(c)))
    depth = count("{") + count("[") - count("]") - F.when(ends_inside, 0).otherwise(1)
    pieces = written(running(pieces.withColumn("_by", depth), ["doc_no"], {"_depth": ("sum", C("_by"))}).drop("_plain"))
    kind = F.when(C("value").rlike(r"^\s*\["), "list").when(C("value").rlike(r'^\s*\{\s*"records"\s*:\s*\['), "records").otherwise("keyed")
    layout = pieces.where("pos = 0").select("doc_no", kind.alias("_layout"))
    pieces = pieces.join(layout, "doc_no").withColumn("_base", F.when(C("_layout") == "records", 2).otherwise(1))
    ends = ~ends_inside & (C("_depth") == C("_base"))
    pieces = running(pieces.withColumn("_ends", ends), ["doc_no"], {"_no": ("sum", C("_ends").cast("long"))}, upto=-1)
    whole = pieces.groupBy("doc_no", "_no", "_layout").agg(
        F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("_p"), F.max("_ends").alias("_whole")).where("_whole")
    body = F.concat(F.array_join(F.transform("_p", lambda x: x["value"]), "}"), F.lit("}"))
    lead = {"list": r"^[\s\[,]*", "records": r'^(\s*\{\s*"records"\s*:\s*\[|[\s,]*)\s*', "keyed": r'(?s)^[\s{,]*"(?:[^"\\]|\\.)*"\s*:\s*'}
    record = F.lit(None).cast("string")
    for name, pattern in lead.items():
        record = F.when(C("_layout") == name, F.regexp_replace(body, pattern, "")).otherwise(record)
    return whole.select("doc_no", C("_no").alias("pos"), record.alias("json"))


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of all documents under ``path``; later ones win under the same store key. Documents are in the order of their paths."""
    rows = split_records(spark, path).select("doc_no", "pos", F.from_json("json", schema.replace(":", " ")).alias("_r"))
    return latest_records(rows)


def last_verdicts(lines: DataFrame) -> DataFrame:
    """Last verdict per company of a log with ``seq, line`` (JSON); blank lines do not count."""
    row = F.from_json("line", "company_name string, verdict string")
    parsed = lines.where(strip(text(C("line"))) != "").select("seq", row.alias("_r")).where("_r.company_name IS NOT NULL")
    return parsed.groupBy(C("_r.company_name").alias("company_name")).agg(F.max_by("_r.verdict", "seq").alias("verdict"))


def parse_page_files(files: DataFrame) -> DataFrame:
    """url, capture time and body of cached pages; files without the url line are skipped."""
    c = C("content")
    header = r"^URL: ([^\n]*)"
    body = F.when(F.instr(c, "\n\n") > 0, F.substr(c, F.instr(c, "\n\n") + 2, F.length(c))).otherwise("")
    return files.where(c.rlike(header)).select(
        strip(F.regexp_extract(c, header, 1)).alias("url"),
        F.regexp_extract(c, r"^URL: [^\n]*\nCAPTURED: ([^\n]*)", 1).try_cast("timestamp").alias("captured_at"),
        body.alias("text"),
    )


def read_page_cache(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """Cached pages: a file each, or many in a file with a ``separator`` (one character) behind each."""
    files = spark.read.text(path, wholetext=True) if separator is None else spark.read.text(path, lineSep=separator)
    return parse_page_files(files.withColumnRenamed("value", "content"))


BINDINGS = "results struct<bindings:array<struct<companyLabel:struct<value:string>,founderLabel:struct<value:string>>>>"


def parse_bindings(replies: DataFrame, col: str = "reply") -> DataFrame:
    """Distinct (company, founder) of the replies of a graph endpoint."""
    b = F.explode(F.from_json(col, BINDINGS)["results"]["bindings"])
    return replies.select(b.alias("_b")).select(
        C("_b.companyLabel.value").alias("company"), C("_b.founderLabel.value").alias("founder")
    ).where("company IS NOT NULL AND founder IS NOT NULL").distinct()


MEMBERS = "query struct<categorymembers:array<struct<title:string>>>"


def parse_members(replies: DataFrame, col: str = "reply") -> DataFrame:
    """Distinct titles of category listings."""
    m = F.explode(F.from_json(col, MEMBERS)["query"]["categorymembers"])
    return replies.select(m.alias("_m")).select(C("_m.title").alias("title")).where("title IS NOT NULL").distinct()


def parse_snapshot(lines: DataFrame, col: str = "line") -> DataFrame:
    """pid, ppid and name of tab-separated process lines; bad lines are dropped."""
    parts = F.split(C(col), "\t")

    def number(i: int) -> Column:
        return strip(F.get(parts, F.lit(i))).try_cast("long")

    return (
        lines.where(F.size(parts) == 3)
        .select(number(0).alias("pid"), number(1).alias("ppid"), strip(F.get(parts, F.lit(2))).alias("name"))
        .where("pid IS NOT NULL AND ppid IS NOT NULL")
    )

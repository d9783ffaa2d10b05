"""Allow and block rules for urls, found by an equi-join on short hash prefixes.

Every url is expanded into host suffixes times path prefixes that end in a
slash. The first bytes of an expression's SHA-256 are the join key, the whole
digest confirms, and of the rules that fit the longest decides. Urls are judged
once per distinct (host, path), so a url or host that fills the table costs one
expansion, and a url is expanded no deeper than the deepest rule, so the cost
grows with its length alone. Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieproof.llm.tables import query, table

PREFIX_DIGITS = 8

RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case. Path: on up to ``? #`` or the end.

    A null url, or one without ``://``, has neither.
    """
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return _ascii_lower(host), path


def _host_suffixes(host: Column, labels: int) -> Column:
    """The host's last ``labels`` parts between dots and each shorter end of it."""
    parts = F.split(host, r"\.", -1)
    return F.array_distinct(F.transform(
        F.sequence(F.greatest(F.size(parts) - labels + 1, F.lit(1)), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
    ))


def _path_prefixes(path: Column, slashes: int) -> Column:
    """The empty prefix and each prefix that ends in a slash and has ``slashes`` of them at most."""
    parts = F.split(path, "/", slashes + 1)
    n = F.size(parts)
    return F.concat(
        F.array(F.lit("")),
        F.when(n > 1, F.transform(
            F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
            lambda i: F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")),
        )).otherwise(F.array().cast("array<string>")),
    )


def _folder(path: Column) -> Column:
    """The path up to and with its last slash."""
    return F.regexp_extract(path, r"(?s)^(.*/)", 1)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages`` (``page_id``, ``url``).

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and
    all subdomains where the url's path starts with the rule's; the longest rule
    wins, then the longer host, then ``block`` over other verdicts. Null parts of
    a rule are empty, a rule without a host fits nothing, repeated rules count
    once. Without a fitting rule: ``rule`` null, ``verdict`` the default. Repeated
    rows stay repeated. No limit on the length of a url; host ends with more
    labels and path prefixes with more slashes than any rule has fit none, so
    they are not tried.

    A rule path that does not end in a slash is found by the folder it is in and
    confirmed as a prefix of the whole path.
    """
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = rules.select(
        _ascii_lower(F.coalesce("host", F.lit(""))).alias("rule_host"),
        F.coalesce("path", F.lit("")).alias("rule_path"),
        F.coalesce("verdict", F.lit(default)).alias("rule_verdict"),
    ).where("rule_host <> ''").distinct()
    known = known.withColumn("digest", F.sha2(F.concat("rule_host", F.lit("\n"), _folder(F.col("rule_path"))), 256))
    known = known.withColumn("short", F.left("digest", F.lit(PREFIX_DIGITS)))

    depth = known.agg(F.max(F.size(F.split("rule_host", r"\.", -1))).alias("labels"),
                      F.max(F.size(F.split("rule_path", "/", -1)) - 1).alias("slashes")).first()
    labels, slashes = depth["labels"] or 1, depth["slashes"] or 0

    urls = judged.where("host <> ''").select("host", "path").distinct()
    tried = urls.select("host", "path", F.explode(_host_suffixes(F.col("host"), labels)).alias("suffix")).select(
        "host", "path", F.explode(F.transform(
            _path_prefixes(F.col("path"), slashes), lambda p: F.sha2(F.concat(F.col("suffix"), F.lit("\n"), p), 256)
        )).alias("tried"))
    fits = tried.withColumn("short", F.left("tried", F.lit(PREFIX_DIGITS))).join(known, "short").where(
        (F.col("tried") == F.col("digest")) & F.startswith("path", F.col("rule_path")))
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("a"), F.length("rule_host").alias("b"),
        (F.col("rule_verdict") == "block").alias("c"), F.col("rule_verdict").alias("d"),
        F.concat("rule_host", "rule_path").alias("rule"),
    )
    best = fits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    return judged.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.d", F.lit(default)).alias("verdict"))


_SQL_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
OP2_SQL = f"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), urls AS (
  SELECT page_id, lower(regexp_extract(coalesce(rest, ''), '^[^/?#]*')) AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(rhost, rpath, verdict) AS (VALUES {_SQL_RULES}),
fits AS (
  SELECT u.*, r.rhost || r.rpath AS rule, r.verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(r.rhost || r.rpath) DESC NULLS LAST) AS k
  FROM urls u LEFT JOIN rules r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE k = 1
"""


@query("op2_url_filter", OP2_SQL)
def op2_url_filter(spark, folder):
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return judge(table(spark, folder, "pages", "page_id", "url"), rules)

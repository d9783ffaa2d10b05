"""Joins of records with verdicts, lookups, pages and claims.

The side that may fan out is always reduced to one row per key first. No join
is forced to broadcast: table sizes decide, and hot keys are left to the
skew handling of adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieproof.functions.names import last_name, lower_key
from tieproof.functions.text import cut, is_blank, text

REJECTED_BUCKETS = ("reject:own-entity", "reject:investment")


def one_per_key(df: DataFrame, key: str, order: str, latest: bool = True) -> DataFrame:
    """Last (or first) row per key; combined on the map side."""
    rest = [c for c in df.columns if c != key]
    pick = F.max_by if latest else F.min_by
    return df.groupBy(key).agg(pick(F.struct(*rest), order).alias("_r")).select(key, "_r.*")


def with_verdict(records: DataFrame, verdicts: DataFrame, key: str, order: str) -> DataFrame:
    """Records with their last verdict by ``order``, UNADJUDICATED when there is none."""
    v = verdicts.groupBy(key).agg(F.max_by("verdict", order).alias("verdict"))
    return records.join(v, key, "left").withColumn("verdict", F.coalesce("verdict", F.lit("UNADJUDICATED")))


def effective_verdict(records: DataFrame, first: DataFrame, recovery: DataFrame, key: str, order: str) -> DataFrame:
    """The last recovery verdict of a key overrides its last first one; logs may repeat keys."""
    f = first.groupBy(key).agg(F.max_by("verdict", order).alias("_first"))
    r = recovery.groupBy(key).agg(F.max_by("verdict", order).alias("_recovery"))
    joined = records.join(f, key, "left").join(r, key, "left")
    return joined.withColumn("verdict", F.coalesce("_recovery", "_first")).drop("_recovery", "_first")


def confirmed_edges(edges: DataFrame, lookup: DataFrame) -> DataFrame:
    """Edges whose company and last name both occur in a lookup of (company, founder)."""
    keyed = edges.withColumn("_last", last_name(F.col("person")))
    known = lookup.select(F.col("company"), last_name(F.col("founder")).alias("_last")).distinct()
    return keyed.where("_last <> ''").join(known, ["company", "_last"], "left_semi").drop("_last")


def registry_check(records: DataFrame, registry: DataFrame, entity: Column) -> DataFrame:
    """company_real, entity_type, source and detail; name rules first, then the registry.

    ``registry`` has ``lookup_name, reg_seq, detail``; the first match per name counts.
    """
    first = one_per_key(registry, "lookup_name", "reg_seq", latest=False).select(
        "lookup_name", F.col("detail").alias("_detail")
    )
    joined = (
        records.withColumn("entity_type", entity)
        .withColumn("_name", lower_key(F.col("company_name")))
        .join(first, F.col("_name") == F.col("lookup_name"), "left")
    )
    by_rule, found = F.col("entity_type") != "unknown", F.col("_detail").isNotNull()
    return joined.withColumns({
        "company_real": F.when(by_rule, F.lit(False)).when(found, F.lit(True)),
        "source": F.when(by_rule, "name-rule").otherwise("registry"),
        "detail": F.when(by_rule, "").when(found, F.col("_detail")).otherwise("no registration match"),
        "entity_type": F.when(by_rule, F.col("entity_type")).when(found, "company").otherwise("unknown"),
    }).drop("_name", "lookup_name", "_detail")


def not_known(new: DataFrame, known: DataFrame, new_key: Column, known_key: Column) -> DataFrame:
    """Rows whose key does not occur among the known ones."""
    keys = known.select(known_key.alias("_k")).distinct()
    return new.withColumn("_k", new_key).join(keys, "_k", "left_anti").drop("_k")


def pages_to_recheck(verdicts: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """UNCLEAR records with the text of their cached page (one per key), or their evidence."""
    unclear = verdicts.where("verdict = 'UNCLEAR'")
    cached = pages.select(key, F.col("text").alias("_page"))
    joined = unclear.join(cached, key, "left")
    return joined.withColumn(
        "page_text", F.when(text(F.col("_page")) != "", F.col("_page")).otherwise(text(F.col("evidence")))
    ).drop("_page")


def match_back(
    wanted: DataFrame, extracted: DataFrame, key: Column, n_found: int | None = None, failed: DataFrame | None = None
) -> DataFrame:
    """Status of each re-extracted record: ok, unmatched, schema_failed, or fetch_failed.

    ``wanted``: ``rec_seq, company_name, url``; ``extracted``: ``url, pos,
    found_name``. An unmatched record lists the names found instead, the first ``n_found``
    or all of its page. ``failed`` has the urls of pages whose replies broke the schema.
    """
    want = wanted.withColumn("_k", key)
    hits = extracted.select("url", F.col("found_name"), "pos")
    found_keys = hits.withColumn("company_name", F.col("found_name")).withColumn("_k", key)
    matched = found_keys.groupBy("url", "_k").agg(F.min("pos").alias("match_pos"))
    if n_found is not None:
        rank = F.row_number().over(Window.partitionBy("url").orderBy("pos"))
        hits = hits.withColumn("_rn", rank).where(F.col("_rn") <= n_found)
    first = (
        hits.where(~is_blank(F.col("url")))
        .groupBy("url").agg(F.array_sort(F.collect_list(F.struct("pos", "found_name"))).alias("_f"))
        .select("url", F.array_join(F.transform("_f", lambda f: f["found_name"]), "; ").alias("_found"))
    )
    joined = want.join(matched, ["url", "_k"], "left").join(first, "url", "left").withColumn("_broken", F.lit(False))
    if failed is not None:
        broken = failed.select("url").distinct().withColumn("_yes", F.lit(True))
        joined = joined.join(broken, "url", "left").withColumn("_broken", F.coalesce("_yes", F.lit(False))).drop("_yes")
    status = (
        F.when(is_blank(F.col("url")), "fetch_failed")
        .when(F.col("_broken"), "schema_failed")
        .when(F.col("match_pos").isNotNull(), "ok")
        .otherwise("unmatched")
    )
    return joined.withColumn("status", status).withColumn(
        "found", F.when(F.col("status") == "unmatched", F.coalesce("_found", F.lit("")))
    ).drop("_k", "_found", "_broken")


def why_excluded(names: DataFrame, rejects: DataFrame) -> DataFrame:
    """First reject row of each asked name, compared trimmed and in lower case."""
    keyed = rejects.withColumn("_k", lower_key(F.col("company_name")))
    first = one_per_key(keyed, "_k", "rec_seq", latest=False).withColumnRenamed("company_name", "rejected_name")
    asked = names.withColumn("_k", lower_key(F.col("company_name")))
    return asked.join(first, "_k").drop("_k")


def rule_dropped(triaged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clear rejects with their log columns, and the records still to be judged."""
    hit = F.col("bucket").isin(*REJECTED_BUCKETS)
    dropped = triaged.where(hit).select(
        "company_name", "rec_seq", F.lit("NONCOMPANY").alias("verdict"),
        F.col("reason").alias("why"), F.lit(True).alias("rule_dropped"),
    )
    return dropped, triaged.where(~hit)


def append_logs(*logs: DataFrame) -> DataFrame:
    out = logs[0]
    for more in logs[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def pattern_tiers(pages: DataFrame, patterns: DataFrame, host: Column, default: int, gram: int = 4) -> DataFrame:
    """Tier of the longest pattern that occurs in each host.

    Substring tests without a nested loop: hosts are cut into all grams of a
    fixed length and met by the first gram of each pattern, then the whole
    pattern is tested. A shorter pattern is met by the grams of its own length.
    """
    hosts = pages.select(host.alias("host")).distinct()
    pieces = F.transform(
        F.sequence(F.lit(1), F.length("host")),
        lambda i: F.transform(F.sequence(F.lit(1), F.lit(gram)), lambda k: F.substr(F.col("host"), i, k)),
    )
    grams = hosts.where(F.length("host") > 0).select("host", F.explode(F.array_distinct(F.flatten(pieces))).alias("_g"))
    keyed = patterns.where("pattern <> ''").withColumn("_g", F.substring("pattern", 1, gram))
    best = (
        grams.join(keyed, "_g").where(F.contains("host", "pattern"))
        .groupBy("host").agg(F.max_by("tier", F.struct(F.length("pattern"), "pattern")).alias("tier"))
    )
    return (
        pages.withColumn("host", host).join(best, "host", "left")
        .withColumn("tier", F.coalesce("tier", F.lit(default)))
    )


def span_samples(claims: DataFrame, matched: Column, good: int = 3, bad: int = 5, max_chars: int | None = None) -> DataFrame:
    """A few matched and unmatched spans per language."""
    ranked = claims.select("lang", "doc_id", cut(F.col("span"), max_chars).alias("sample"), matched.alias("ok")).withColumn(
        "_rn", F.row_number().over(Window.partitionBy("lang", "ok").orderBy("doc_id"))
    )
    return ranked.where(F.col("_rn") <= max(good, bad)).where(
        F.col("_rn") <= F.when(F.col("ok"), good).otherwise(bad)
    ).drop("_rn")

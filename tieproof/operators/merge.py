"""Merging records that share a key.

Every merge is one aggregation: each field keeps the value of the best row that
has one (``min_by`` over the order of preference), so rows are combined before
the shuffle and a key that holds a third of all rows is no special case. Lists
that grow with the group (names, sources, people) stay tables of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieproof.config import Config
from tieproof.functions import rules
from tieproof.functions.names import canonical_name, name_key
from tieproof.functions.text import is_blank, text
from tieproof.session import spread

FILL_FIELDS = (
    "description", "industry", "funding_stage", "funding_last_round_year", "founded_year", "is_public",
    "headquarters", "exit_year", "acquirer", "website_url", "linkedin_company_url", "crunchbase_url",
)
MAX_FIELDS = ("funding_total_usd", "employee_count", "acquisition_amount_usd")


def first_where(value: Column, keep: Column, order: Column) -> Column:
    """Value of the first row, in ``order``, for which ``keep`` holds."""
    return F.min_by(F.when(keep, value), F.when(keep, order))


def is_unset(c: Column) -> Column:
    return c.isNull() | c.cast("string").isin("", "unknown")


def _grouped_by_canonical(df: DataFrame) -> DataFrame:
    """Rows with an empty canonical name stand alone under their own sequence number."""
    cn = canonical_name(F.col("company_name"))
    return df.withColumn("canonical", cn).withColumn("_solo", F.when(F.col("canonical") == "", F.col("rec_seq")))


def preference() -> Column:
    """Better tier first, input order among equals."""
    return F.struct(-rules.tier_rank(F.col("validation_tier")), F.col("rec_seq"))


def dedup_merge(df: DataFrame) -> DataFrame:
    """One row per canonical name.

    Columns that no rule fills are those of the base row; lists are ``united``, as rows.
    """
    have, order = set(df.columns), preference()
    always = F.lit(True)
    aggs = [
        F.count("*").alias("n_merged"),
        F.min_by("rec_seq", order).alias("rec_seq"),
        F.min_by("company_name", order).alias("company_name"),
        F.min_by("validation_tier", order).alias("validation_tier"),
        F.min_by("proof_url", order).alias("proof_url"),
    ]
    for f in FILL_FIELDS:
        if f in have:
            best = first_where(F.col(f), ~is_unset(F.col(f)), order)
            aggs.append(F.coalesce(best, first_where(F.col(f), always, order)).alias(f))
    for f in MAX_FIELDS:
        if f in have:
            aggs.append(F.max(f).alias(f))
    done = {"rec_seq", "company_name", "validation_tier", "proof_url", "status", "canonical", "n_merged", *FILL_FIELDS, *MAX_FIELDS}
    aggs += [F.min_by(f, order).alias(f) for f, kind in df.dtypes if f not in done and not is_list(kind)]
    known = first_where(F.col("status"), F.col("status") != "unknown", order)
    aggs.append(F.coalesce(known, F.lit("unknown")).alias("status"))
    return _grouped_by_canonical(df).groupBy("canonical", "_solo").agg(*aggs).drop("_solo")


def dedup_names(df: DataFrame) -> DataFrame:
    """Distinct original names of every canonical name that merged several rows.

    ``n_rows`` counts the rows under that name, ``is_base`` marks the one the
    merge started from, ``group_rows`` is the size of the whole group.
    """
    named = _grouped_by_canonical(df).where("canonical <> ''")
    per_name = named.groupBy("canonical", "company_name").agg(
        F.count("*").alias("n_rows"), F.min(preference()).alias("_best")
    )
    per_group = per_name.groupBy("canonical").agg(
        F.sum("n_rows").alias("group_rows"), F.min("_best").alias("_base")
    ).where("group_rows > 1")
    return (
        per_name.join(per_group, "canonical")
        .withColumn("is_base", F.col("_best") == F.col("_base"))
        .drop("_best", "_base")
    )


def dedup_issues(df: DataFrame) -> DataFrame:
    """``deduped-with:<name>`` notes, one row per canonical name and merged name."""
    names = dedup_names(df)
    return names.where(~F.col("is_base") | (F.col("n_rows") > 1)).select(
        "canonical", F.concat(F.lit("deduped-with:"), F.coalesce("company_name", F.lit("?"))).alias("issue")
    )


def dedup_report(df: DataFrame, n: int = 25) -> DataFrame:
    """The ``n`` largest groups with their original names."""
    named = _grouped_by_canonical(df).where("canonical <> ''")
    groups = named.groupBy("canonical").agg(
        F.count("*").alias("group_rows"), F.min_by("validation_tier", preference()).alias("kept_tier")
    )
    largest = groups.where("group_rows > 1").orderBy(F.desc("group_rows"), "canonical").limit(n)
    names = named.groupBy("canonical", "company_name").agg(F.count("*").alias("n_rows"))
    return names.join(F.broadcast(largest), "canonical")  # at most n rows


def dedup_people(df: DataFrame, people: DataFrame) -> DataFrame:
    """Affiliations of merged records: one row per canonical name and person, first wins.

    ``people`` has ``rec_seq, pos, person`` and any further fields; of unnamed
    entries only the last one of the base record survives.
    """
    keyed = _grouped_by_canonical(df).select("rec_seq", "canonical", "_solo", preference().alias("_order"))
    base = keyed.groupBy("canonical", "_solo").agg(F.min("_order").alias("_base"))
    rows = people.join(keyed, "rec_seq").withColumn("_rank", F.struct("_order", "pos"))
    extra = [c for c in people.columns if c not in ("rec_seq", "person")]
    named = rows.where(~is_blank(F.col("person"))).groupBy("canonical", "_solo", "person").agg(
        *[F.min_by(c, "_rank").alias(c) for c in extra]
    )
    same_group = rows["canonical"].eqNullSafe(base["canonical"]) & rows["_solo"].eqNullSafe(base["_solo"])
    unnamed = (
        rows.where(is_blank(F.col("person"))).join(base, same_group).where(F.col("_order") == F.col("_base"))
        .groupBy(rows["canonical"], rows["_solo"]).agg(F.max_by(F.struct("person", *extra), "pos").alias("_u"))
        .select("canonical", "_solo", "_u.*")
    )
    return named.unionByName(unnamed).drop("_solo")


# --- store merge ---------------------------------------------------------------

#: Fields whose differing values are reported.
CONFLICT_FIELDS = (
    "description", "industry", "funding_total_usd", "funding_stage", "funding_last_round_year", "founded_year", "employee_count",
    "is_public", "headquarters", "status", "exit_year", "acquirer", "acquisition_amount_usd", "website_url",
    "linkedin_company_url", "crunchbase_url",
)
#: Columns that a merge sets by itself.
OWN = ("name_key", "rec_seq", "verified", "n_sources", "n_merged", "_from")


def is_list(kind: str) -> bool:
    return kind.startswith(("array", "map", "struct"))


def united(df: DataFrame, key: str, order: Column, fields=("tags", "validation_issues")) -> DataFrame:
    """``key, field, value, first``: the values of list columns of all rows of a key, each once, in the order they came."""
    def values(f: str) -> Column:
        cells = F.coalesce(F.col(f), F.array().cast("array<string>"))
        return F.transform(cells, lambda v: F.struct(F.lit(f).alias("field"), v.cast("string").alias("value")))

    lists = [values(f) for f in fields if f in df.columns]
    rows = df.select(key, order.alias("_o"), F.posexplode(F.concat(*lists)).alias("_at", "_v"))
    return rows.where(text(F.col("_v.value")) != "").groupBy(key, "_v.field", "_v.value").agg(
        F.min(F.struct("_o", "_at")).alias("first"))


def admitted(df: DataFrame, cfg: Config) -> DataFrame:
    """Records the store accepts: a usable key, no rule against the name, a founder or a licence."""
    founder = ~is_blank(F.col("founder"))
    licensed = F.lower(F.trim(text(F.col("affiliation_type")))) == "licensed tech"
    return (
        df.withColumn("name_key", name_key(F.col("company_name")))
        .where(F.col("name_key") != "")
        .where(rules.non_company_reason(F.col("company_name"), cfg).isNull())
        .where(founder | licensed)
    )


def backfill_founder(df: DataFrame) -> DataFrame:
    """Flat founder fields out of the first person of records in the nested layout."""
    first = F.get(F.col("people"), F.lit(0))
    need = is_blank(F.col("founder")) & (F.size("people") > 0)
    joined = F.array_join(F.filter(F.transform("people", lambda p: p["name"]), lambda n: text(n) != ""), ", ")
    return df.withColumns({
        "founder": F.when(need, F.when(text(first["name"]) != "", first["name"]).otherwise(joined))
        .otherwise(F.col("founder")),
        "evidence": F.when(need & (text(F.col("evidence")) == ""), first["evidence_span"]).otherwise(F.col("evidence")),
        "affiliation_type": F.when(
            need & (text(F.col("affiliation_type")) == ""), F.initcap(F.coalesce(first["role"], F.lit("alumnus")))
        ).otherwise(F.col("affiliation_type")),
    })


def merge_fields(df: DataFrame, order: str = "rec_seq") -> DataFrame:
    """One row per ``name_key``: blanks filled in the order of a whole number of less than 61 bits.

    A real value beats "Unknown"; "Unknown" beats nothing, and the last spelling
    of it stays. All columns but lists are merged; lists are ``united``, as rows.
    The preference among values is one number, so a text is kept beside eight bytes.
    Rows are sorted before they are combined, so they are spread first.
    """
    o = F.col(order).cast("long")
    aggs = [F.min(order).alias(order), F.count("*").alias("n_merged")]
    for f, kind in df.dtypes:
        if f in OWN or f == order or is_list(kind):
            continue
        c, shown = F.col(f), F.col(f).cast("string")
        vague = shown.isin("Unknown", "unknown")
        preference_ = F.when(shown.isin("", "0", "0.0", "false"), F.lit(1 << 62) + o).when(vague, -o).otherwise(F.lit(-1 << 62) + o)
        aggs.append(F.min_by(c, F.when(c.isNotNull(), preference_)).alias(f))
    aggs.append(F.max(F.coalesce("verified", F.lit(False))).alias("verified"))
    return spread(df, order).groupBy("name_key").agg(*aggs)


def upsert_merge(df: DataFrame, order: str = "rec_seq") -> DataFrame:
    """``merge_fields`` with the number of different sources; two of them verify a record.

    Sources are counted apart, since a distinct count beside the fields would carry
    all of them through one more grouping, by key and source.
    """
    sources = df.where(~is_blank(F.col("source_url"))).select("name_key", "source_url").distinct()
    counts = sources.groupBy(F.col("name_key").alias("_k")).agg(F.count("*").alias("n_sources"))
    merged = merge_fields(df, order)
    merged = merged.join(counts, F.col("name_key").eqNullSafe(F.col("_k")), "left").drop("_k")
    merged = merged.withColumn("n_sources", F.coalesce("n_sources", F.lit(0).cast("long")))
    return merged.withColumn("verified", F.col("verified") | (F.col("n_sources") >= 2))


def conflicts(df: DataFrame, fields=CONFLICT_FIELDS, order: str = "rec_seq") -> DataFrame:
    """Values that lost against an earlier, different one: key, field, kept, rejected, count.

    The kept values of a key are one row that meets its records, so that only cells
    which lost become rows. Records are spread before they are sorted by key.
    """
    fields = [f for f in fields if f in df.columns]
    told = {f: F.col(f).cast("string") for f in fields}
    cells = spread(df.select("name_key", F.col(order).alias("_o"), *[
        F.when(~v.isin("", "unknown"), v).alias(f) for f, v in told.items()]), "_o")
    kept = cells.groupBy("name_key").agg(*[F.min_by(f, F.when(F.col(f).isNotNull(), F.col("_o"))).alias("_" + f) for f in fields])

    def lost(f: str) -> Column:
        first, value = F.col("_" + f), F.col(f)
        differs = (value != first) & ~value.isin("0", "false") & ~first.isin("0", "false")
        return F.when(differs, F.struct(F.lit(f).alias("field"), first.alias("kept"), value.alias("rejected")))

    rows = cells.join(kept, "name_key").select("name_key", F.explode(F.array(*[lost(f) for f in fields])).alias("_l"))
    return rows.where("_l IS NOT NULL").select("name_key", "_l.*").groupBy("name_key", "field", "kept", "rejected").agg(
        F.count("*").alias("n"))


def overlay(base: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """Rows of ``base`` replaced by those of ``patch`` under the same key, with their origin."""
    names = [c for c in base.columns if c != key]
    b = base.select(key, F.lit(True).alias("_in_base"), F.struct(*names).alias("_base"))
    p = patch.select(key, F.lit(True).alias("_in_patch"), F.struct(*names).alias("_patch"))
    row = F.when(F.col("_in_patch"), F.col("_patch")).otherwise(F.col("_base"))
    return b.join(p, key, "full").select(
        key, row.alias("_row"), F.when(F.col("_in_patch"), "patch").otherwise("base").alias("origin")
    ).select(key, "_row.*", "origin")


def last_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the highest ``order`` under each key; rows combine before the shuffle."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")

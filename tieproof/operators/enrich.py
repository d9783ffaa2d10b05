"""Facts out of article leads, article look-up by title variants, filling of empty fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieproof.functions.text import ci, cut, strip, text

# Fact patterns of an article lead.
FOUNDED = r"\b(?:founded|established|incorporated)\s+(?:in\s+)?(\d{4})"
ACQUIRED = r"\bacquired\s+(?:by|in\s+\d{4}\s+by)?\s+([^.,;]+?)(?:\s+(?:in|for|on)\b|\.|,|;|$)"
HEADQUARTERS = r"\b(?:headquartered|based)\s+in\s+([^.,;]+?)(?:\.|,|;|$)"
PUBLIC = r"\b(?:went public|ipo|listed on|initial public offering)\b"
CLOSED = r"\b(?:shut down|ceased operations|defunct|dissolved|wound down)\b"
# Title variants, in the order they are tried.
TITLE_VARIANTS = ("", " (company)", " (firm)", " Inc.", ", Inc.", " Corporation")
# Words that make an article one about a company.
COMPANY_WORDS = (
    "company", "startup", "firm", "corporation", "founded", "headquartered", "subsidiary",
    "acquired", "raised", "venture", "fund", "bank", "technology", "software", "platform",
    "biotech", "pharmaceuticals", "labs",
)
LEGAL_FORM_END = r",?\s*(?:Inc\.?|LLC|Ltd\.?|Corp\.?|Corporation)$"
# Fixed value: the issue of a record that an article was found for.
ENRICHED = "wikipedia-enriched"
# Fields that an article may fill.
FILLABLE = ("status", "founded_year", "headquarters", "acquirer")


def article_facts(lead: Column) -> Column:
    """struct of the facts a lead states; null where it is silent."""
    t = text(lead)
    year = F.regexp_extract(t, ci(FOUNDED), 1).try_cast("int")
    acquirer = F.rtrim(strip(F.regexp_extract(t, ci(ACQUIRED), 1)), F.lit(".,"))
    place = F.rtrim(strip(F.regexp_extract(t, ci(HEADQUARTERS), 1)), F.lit(".,"))
    public = t.rlike(ci(PUBLIC))
    return F.struct(
        F.when(year.between(1800, 2030), year).alias("founded_year"),
        F.when(public, "ipo").when(t.rlike(ci(ACQUIRED)), "acquired").when(t.rlike(ci(CLOSED)), "shutdown").alias("status"),
        F.when((acquirer != "") & (F.length(acquirer) < 80), acquirer).alias("acquirer"),
        F.when(public, F.lit(True)).alias("is_public"),
        F.when((place != "") & (F.length(place) < 120), place).alias("headquarters"),
    )


def migration_evidence(evidence: Column, description: Column, kind: Column) -> Column:
    """Everything a flat record says about the tie, in one line."""
    joined = F.concat(text(evidence), F.lit(" | "), text(description), F.lit(" | type="), text(kind))
    empty = (text(evidence) == "") & (text(description) == "") & (text(kind) == "")
    return F.when(empty, F.lit("")).otherwise(F.btrim(joined, F.lit(" |")))


def find_articles(
    names: DataFrame, articles: DataFrame, name: str = "company_name", lead_chars: int | None = None
) -> DataFrame:
    """Best article per distinct name.

    Twelve title variants per name are looked up with one equi-join; among the
    hits the first with a company word (in its first ``lead_chars``, if asked) wins, else the first. Keeping one row per
    name is a rank filter, which Spark also applies before the shuffle.
    """
    cleaned = strip(F.col(name))
    short = strip(F.regexp_replace(cleaned, "(?i)" + LEGAL_FORM_END, ""))
    variants = F.array(*[F.concat(n, F.lit(v)) for v in TITLE_VARIANTS for n in (cleaned, short)])
    wanted = (
        names.select(name).where(strip(text(F.col(name))) != "").distinct()
        .select(name, F.posexplode(variants).alias("variant", "title"))
    )
    usable = articles.where((F.col("type") != "disambiguation") & (text(F.col("title")) != ""))
    one_per_title = usable.withColumn(
        "_rn", F.row_number().over(Window.partitionBy("title").orderBy("article_id"))
    ).where("_rn = 1").drop("_rn")
    hay = F.concat(F.lower(text(F.col("description"))), F.lit(" "), cut(F.lower(text(F.col("extract"))), lead_chars))
    about_company = F.lit(False)
    for w in COMPANY_WORDS:
        about_company = about_company | F.contains(hay, F.lit(w))
    best = Window.partitionBy(name).orderBy(F.col("about_company").desc(), "variant")
    return (
        wanted.join(one_per_title, "title")
        .withColumn("about_company", about_company)
        .withColumn("_rn", F.row_number().over(best))
        .where("_rn = 1")
        .drop("_rn")
    )


def fill_from_articles(records: DataFrame, found: DataFrame, name: str = "company_name") -> DataFrame:
    """Fill empty fields of the records from the article found under their name, and note that in their issues."""
    facts = article_facts(F.col("extract"))
    info = found.select(
        name,
        F.lit(True).alias("_hit"),
        F.concat(F.lit("https://en.wikipedia.org/wiki/"), F.replace(F.url_encode("title"), F.lit("+"), F.lit("%20")))
        .alias("wikipedia_url"),
        *[facts[f].alias("_" + f) for f in FILLABLE],
        facts["is_public"].alias("_is_public"),
    )
    out = records.join(info, name, "left")
    issues = F.col("validation_issues") if "validation_issues" in records.columns else F.array().cast("array<string>")
    issues = F.coalesce(issues, F.array().cast("array<string>"))
    out = out.withColumn("validation_issues", F.when(
        F.col("_hit"), F.array_sort(F.array_union(issues, F.array(F.lit(ENRICHED))))).otherwise(issues))
    for f in FILLABLE:
        old = F.col(f)
        empty = old.isNull() | old.cast("string").isin("", "unknown", "0")
        out = out.withColumn(f, F.when(empty & F.col("_" + f).isNotNull(), F.col("_" + f)).otherwise(old))
    return out.withColumns({
        "is_public": F.when(F.col("_is_public"), F.lit(True)).otherwise(F.col("is_public")),
        "enriched": F.coalesce(F.col("_hit"), F.lit(False)),
    }).drop("_hit", "_is_public", *["_" + f for f in FILLABLE])

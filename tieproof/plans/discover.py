"""Candidate discovery from category listings, and enrichment from articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieproof.config import Config
from tieproof.functions.names import canonical_name_short
from tieproof.functions.rules import looks_like_company_title
from tieproof.functions.text import text
from tieproof.operators.enrich import article_facts, fill_from_articles, find_articles
from tieproof.operators.joins import not_known

C = F.col


def new_titles(titles: DataFrame, records: DataFrame) -> DataFrame:
    """Company-like titles whose short canonical name no record has."""
    fresh = titles.where(looks_like_company_title(C("title"))).select("title").distinct()
    return not_known(fresh, records, canonical_name_short(C("title")), canonical_name_short(C("company_name")))


def discover(titles: DataFrame, records: DataFrame, articles: DataFrame, cfg: Config) -> DataFrame:
    """New titles with whether their article mentions the institution."""
    hay = F.lower(F.concat(text(C("description")), F.lit(" "), text(C("extract"))))
    signal = articles.groupBy("title").agg(F.max(F.contains(hay, F.lit(cfg.institution_word))).alias("_signal"))
    found = new_titles(titles, records).join(signal, "title", "left")
    confirmed = F.coalesce("_signal", F.lit(False))
    return found.select("title", F.when(confirmed, "confirmed").otherwise("rejected_no_signal").alias("outcome"))


def enrich(records: DataFrame, articles: DataFrame) -> DataFrame:
    return fill_from_articles(records, find_articles(records, articles))


def enrichment_summary(records: DataFrame, articles: DataFrame) -> DataFrame:
    """Names asked, hits, misses, hit rate and how often each fact was found."""
    names = records.select("company_name").where(text(C("company_name")) != "").distinct()
    found = find_articles(records, articles)
    facts = article_facts(C("extract"))
    hits = found.select("company_name", F.lit(True).alias("hit"), facts.alias("_f"))
    return names.join(hits, "company_name", "left").agg(
        F.count("*").alias("queried"),
        F.count("hit").alias("hits"),
        (F.count("*") - F.count("hit")).alias("misses"),
        F.round(F.count("hit") / F.greatest(F.count("*"), F.lit(1)), 3).alias("hit_rate"),
        F.count("_f.status").alias("status_found"),
        F.count("_f.headquarters").alias("headquarters_found"),
        F.count("_f.founded_year").alias("founded_year_found"),
    )

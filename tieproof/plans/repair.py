"""Filling gaps from found facts, promoting stranded founders, revalidating a backlog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieproof.config import Config
from tieproof.functions import rules
from tieproof.functions.names import is_human_name
from tieproof.functions.text import cut, is_blank, quoted, strip, text
from tieproof.operators.stats import gap_counts

C = F.col


def fill_apply(records: DataFrame, found: DataFrame, cfg: Config, max_chars: int | None = None) -> DataFrame:
    """Apply found founders and urls to records that lack them, then revalidate.

    ``found``: ``rec_seq, found_founders, found_url, page_url, page_text``. A page
    that said anything counts as one more source. Thin evidence becomes the page's
    text, whole or its first ``max_chars``.
    """
    out = records.join(found, "rec_seq", "left")
    names, url = strip(text(C("found_founders"))), strip(text(C("found_url")))
    take_name = rules.missing_founder(C("founder"), C("affiliation_type")) & ~F.lower(names).isin("", "unknown", "n/a")
    take_url = rules.missing_text(C("proof_url")) & ~F.lower(url).isin("", "unknown", "n/a") & F.startswith(url, F.lit("http"))
    thin = F.length(strip(text(C("evidence")))) < 15
    said = (names != "") | (url != "")
    new_source = said & (text(C("page_url")) != text(C("source_url")))
    n_sources = (~is_blank(C("source_url"))).cast("int") + F.coalesce(new_source, F.lit(False)).cast("int")
    out = out.withColumns({"_name": take_name, "_url": take_url, "n_sources": n_sources, "_said": said})
    out = out.withColumns({
        "evidence": F.when(
            C("_name") & thin,
            F.concat(F.lit("Found via targeted gap-fill search: "), strip(cut(C("page_text"), max_chars))),
        ).otherwise(C("evidence")),
        "founder": F.when(C("_name"), strip(F.get(F.split(names, ","), F.lit(0)))).otherwise(C("founder")),
        "founders": F.when(C("_name"), names).otherwise(C("founders")),
        "proof_url": F.when(C("_url"), url).otherwise(C("proof_url")),
        "verified": C("verified") | (C("_said") & (C("n_sources") >= 2)),
        "updated": C("_name") | C("_url"),
    })
    return rules.validate(out.drop("_name", "_url", "_said"), cfg)


def repair_founder(records: DataFrame, cfg: Config) -> DataFrame:
    """Promote the first listed founder where the main field is no name, then revalidate."""
    main, listed = strip(text(C("founder"))), strip(text(C("founders")))
    primary = strip(F.get(F.split(listed, ","), F.lit(0)))
    promote = ~is_human_name(main) & (listed != "") & is_human_name(primary)
    thin = F.length(strip(text(C("evidence")))) < 15
    out = records.withColumn("promoted", promote).withColumns({
        "evidence": F.when(
            C("promoted") & thin,
            F.concat(F.lit("Recovered from a prior gap-fill result: founders="), quoted(listed)),
        ).otherwise(C("evidence")),
        "founder": F.when(C("promoted"), primary).otherwise(C("founder")),
    })
    return rules.validate(out, cfg)


def backlog(records: DataFrame, cfg: Config) -> DataFrame:
    """Revalidate everything: tier changes, gaps and re-extraction candidates as named numbers."""
    checked = rules.validate(records.withColumn("_old", C("validation_tier")), cfg)
    changed = checked.agg(
        F.count_if(C("_old") != C("validation_tier")).alias("tier_changes"),
        F.count_if((C("validation_tier") == "weak") & ~is_blank(C("proof_url"))).alias("weak_with_proof"),
    )
    gaps = gap_counts(records)

    def long(df: DataFrame) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("metric"), C(c).cast("long").alias("value")) for c in df.columns])
        return df.select(F.explode(pairs).alias("_m")).select("_m.*")

    return long(changed).union(long(gaps))

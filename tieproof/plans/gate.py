"""The verification gate: all signals of a record joined, scored and decided."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieproof.config import Config
from tieproof.functions import rules, scoring
from tieproof.functions.names import last_name
from tieproof.functions.text import cut, once, text
from tieproof.functions.urls import domain
from tieproof.operators.joins import effective_verdict, one_per_key, registry_check

C = F.col


def signals(
    records: DataFrame, verdicts: DataFrame, recovery: DataFrame, bindings: DataFrame, registry: DataFrame, cfg: Config
) -> DataFrame:
    """Records with verdict, edge confirmation, company check, source tier and tie.

    Verdict logs may repeat a name; the last line counts.
    """
    known = bindings.select(
        C("company").alias("company_name"), last_name(C("founder")).alias("_last"), F.lit(True).alias("_edge")
    ).where("_last <> ''").distinct()
    rows = effective_verdict(records, verdicts, recovery, "company_name", "seq")
    rows = rows.withColumn("_last", last_name(C("founder"))).join(known, ["company_name", "_last"], "left")
    rows = registry_check(rows, registry, rules.entity_type(C("company_name"), cfg))
    return rows.withColumns({
        "api_confirmed": F.coalesce("_edge", F.lit(False)),
        "source_tier": scoring.source_tier(C("proof_url"), cfg),
        "tie": scoring.tie(C("affiliation_type")),
    }).drop("_edge", "_last")


def decided(rows: DataFrame, cfg: Config) -> DataFrame:
    """Score, contradiction test, decision and entity note."""
    sources = F.when(C("api_confirmed"), 2).otherwise(1)
    out = rows.withColumn(
        "_s", once(scoring.score(C("source_tier"), sources, C("api_confirmed"), C("tie"), C("verdict"), cfg))
    ).withColumn("contradiction", ~scoring.consistent(C("founder"), C("evidence")))
    out = out.withColumn("confidence", C("_s.confidence")).withColumn(
        "_d",
        once(scoring.decide(
            C("verdict"), C("company_real"), C("entity_type"), C("tie"), C("confidence"), C("contradiction"), cfg
        )),
    )
    note = scoring.entity_note(C("company_real"), C("source"), C("entity_type"), C("api_confirmed"))
    return out.withColumns({
        "publishable": C("_s.publishable"),
        "provenance": C("_s.provenance"),
        "state": C("_d.state"),
        "reason": C("_d.reason"),
        "entity_verified": note["verified"],
        "entity_note": note["note"],
        "confidence_provenance": scoring.provenance_text(C("_s.confidence"), C("_s.provenance")),
        "source_domain": domain(C("proof_url")),
    }).drop("_s", "_d")


def gate(records, verdicts, recovery, bindings, registry, cfg: Config) -> DataFrame:
    return decided(signals(records, verdicts, recovery, bindings, registry, cfg), cfg)


def published(gated: DataFrame, state: str) -> DataFrame:
    """One of the three outputs; the verified one by falling confidence."""
    out = gated.where(C("state") == state)
    return out.orderBy(F.desc("confidence"), "company_name") if state == "verified" else out


def apply_verdicts(records: DataFrame, verdicts: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Founders are kept; all other records go to the reject table with verdict and evidence."""
    v = one_per_key(verdicts, "company_name", "seq").select("company_name", "verdict")
    joined = records.join(v, "company_name", "left").withColumn(
        "verdict", F.coalesce("verdict", F.lit("UNADJUDICATED"))
    )
    return joined.select(
        "rec_seq", "company_name", "founder", "verdict",
        F.when(C("verdict") == "FOUNDER", "kept").otherwise("rejected").alias("action"),
        domain(C("proof_url")).alias("source_domain"),
        cut(text(C("evidence")), max_chars).alias("evidence"),
    )

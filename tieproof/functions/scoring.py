"""Confidence of a founding edge, contradiction test and the gate decision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tieproof.config import Config
from tieproof.functions.names import last_name
from tieproof.functions.text import ci, strip, text
from tieproof.functions.urls import domain

# Outcomes that settle a case.
NON_COMPANY_TYPES = (
    "university_unit", "investment_fund", "foundation", "nonprofit", "journal", "government_program",
)
NON_FOUNDER_VERDICTS = ("EMPLOYEE", "EXECUTIVE", "INVESTOR", "DONOR", "ATTENDEE", "NONCOMPANY")
FOUNDER_PHRASE = r"\b(founder|co-?founder|founded by)\b[^.]{0,40}"


def source_tier(proof_url: Column, cfg: Config) -> Column:
    return F.when(domain(proof_url).isin(*cfg.directory_domains), "directory").otherwise("mention")


def tie(affiliation_type: Column) -> Column:
    return F.when(strip(text(affiliation_type)) != "", "strong").otherwise("weak")


def score(tier: Column, sources: Column, api: Column, tie_: Column, verdict: Column, cfg: Config) -> Column:
    """struct(confidence, publishable, provenance)."""
    w = cfg.signal_weights
    api = F.coalesce(api, F.lit(False))
    extra = F.greatest(sources - 1, F.lit(0))
    listed, strong = tier == "directory", tie_ == "strong"
    founder = F.coalesce(verdict == "FOUNDER", F.lit(False))
    total = (
        F.when(listed, w["directory"]).otherwise(0.0)
        + F.when(api, w["api"]).otherwise(0.0)
        + extra * w["extra_source"]
        + F.when(strong, w["strong_tie"]).otherwise(0.0)
        + F.when(founder, w["verdict"]).otherwise(0.0)
    )
    agreed = api & (sources >= 2)
    capped = F.least(F.lit(1.0), total)
    value = F.when(agreed, F.greatest(capped, F.lit(cfg.publish_threshold))).otherwise(capped)
    provenance = F.filter(
        F.array(
            F.when(listed, "directory-source"),
            F.when(api, "api-confirmed"),
            F.when(extra > 0, F.concat(F.lit("corroborations="), sources.cast("string"))),
            F.when(strong, "strong-tie"),
            F.when(founder, "verdict-founder"),
            F.when(agreed, "structured-agreement"),
        ),
        lambda p: p.isNotNull(),
    )
    return F.struct(
        F.round(value, 3).alias("confidence"),
        ((value >= cfg.publish_threshold) | agreed).alias("publishable"),
        provenance.alias("provenance"),
    )


def consistent(founder: Column, evidence: Column) -> Column:
    """False only when the evidence names somebody else as the founder."""
    last, ev = last_name(founder), text(evidence)
    phrase = F.regexp_extract(ev, ci(FOUNDER_PHRASE), 0)
    return (
        (last == "")
        | F.contains(F.lower(ev), last)
        | (phrase == "")
        | F.contains(F.lower(phrase), last)
    )


def decide(verdict, company_real, entity, tie_, confidence, contradiction, cfg: Config) -> Column:
    """struct(state, reason)."""
    not_company = F.coalesce(entity.isin(*NON_COMPANY_TYPES), F.lit(False)) | F.coalesce(
        company_real == F.lit(False), F.lit(False)
    )
    no_tie = tie_ == "none"
    other_role = F.coalesce(verdict.isin(*NON_FOUNDER_VERDICTS), F.lit(False))
    sure = (confidence >= cfg.publish_threshold) & (verdict.isNull() | (verdict == "FOUNDER"))
    state = (
        F.when(contradiction, "needs_human")
        .when(not_company | no_tie | other_role, "rejected")
        .when(sure, "verified")
        .otherwise("needs_human")
    )
    reason = (
        F.when(contradiction, F.lit("founder/evidence contradiction"))
        .when(not_company, F.concat(F.lit("not-a-company ("), F.coalesce(entity, F.lit("None")), F.lit(")")))
        .when(no_tie, "no institution tie")
        .when(other_role, F.concat(F.lit("role="), F.lower(verdict)))
        .when(sure, "founding confirmed")
        .otherwise(F.concat(F.lit("insufficient confidence ("), confidence.cast("string"), F.lit(")")))
    )
    return F.struct(state.alias("state"), reason.alias("reason"))


def entity_note(company_real, source, entity, api) -> Column:
    """struct(verified, note); an unconfirmed entity never disqualifies."""
    src, kind = F.coalesce(source, F.lit("registry")), F.coalesce(entity, F.lit("unknown"))
    real, unreal = F.coalesce(company_real, F.lit(False)), company_real == F.lit(False)
    api = F.coalesce(api, F.lit(False))
    verified = F.when(real | api, F.lit(True)).when(unreal, F.lit(False))
    note = (
        F.when(real, F.concat(F.lit("entity confirmed ("), src, F.lit(")")))
        .when(api, "entity confirmed (graph)")
        .when(unreal, F.concat(F.lit("flagged non-company ("), kind, F.lit(", name-rule)")))
        .otherwise("entity UNVERIFIED -- no registry/graph match (not disqualifying)")
    )
    return F.struct(verified.alias("verified"), note.alias("note"))


def provenance_text(confidence: Column, provenance: Column) -> Column:
    return F.concat(F.format_string("%.2f", confidence), F.lit(" | "), F.array_join(provenance, "; "))

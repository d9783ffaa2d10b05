"""Whole-record steps: typing, schema check, filters and lists over the record set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieproof.config import Config
from tieproof.functions import rules, typing
from tieproof.functions.text import is_blank, quoted, text


def typed_fields(df: DataFrame, cfg: Config) -> DataFrame:
    """Loose fields next to their typed value and the error of the typed schema."""
    money = typing.money_typed(F.col("funding_text"))
    exit_year = typing.year_typed(F.col("exit_year"))
    heads = typing.count_range(F.col("employees_text"))
    return df.withColumns({
        "funding_value": money["value"], "funding_error": money["error"],
        "exit_value": exit_year["value"], "exit_error": exit_year["error"],
        "employee_value": heads["value"], "employee_error": heads["error"],
        "status_value": typing.status(F.col("status_text"), typing.bool3(F.col("is_public"))),
    })


def _not_allowed(name: str, value: Column, allowed) -> Column:
    return F.when(~text(value).isin(*allowed), F.concat(F.lit(f"{name} not allowed: "), quoted(text(value))))


def people_error(people: Column, schools) -> Column:
    """The first error of the people of a record, null if all are right. There must be one at least."""
    def of(p: Column) -> Column:
        year = p["grad_year"]
        low, high = rules.GRAD_YEARS
        return F.coalesce(
            F.when(is_blank(p["name"]), F.lit("name must be non-empty")),
            _not_allowed("school", p["school"], schools),
            _not_allowed("role", p["role"], rules.ROLES),
            F.when((year < low) | (year > high), F.concat(F.lit("grad_year out of range: "), year.cast("string"))),
            _not_allowed("role_at_company", p["role_at_company"], rules.COMPANY_ROLES),
            F.when(is_blank(p["evidence_span"]), F.lit("evidence_span must be non-empty")),
        )

    first = F.get(F.array_compact(F.transform(people, of)), F.lit(0))
    return F.when(F.coalesce(F.size(people), F.lit(0)) < 1, F.lit("people must not be empty")).otherwise(first)


def check_schema(df: DataFrame, cfg: Config) -> DataFrame:
    """Add ``ok`` and the first ``error``: required text, people, allowed values, typed errors.

    Records without a column ``people`` are in the flat layout and need evidence of their own.
    """
    stage, not_allowed = text(F.col("funding_stage")), _not_allowed
    schools = {"unknown", cfg.school_default[1], *(name for _, name in cfg.school_patterns)}
    if "people" in df.columns:
        tie = people_error(F.col("people"), sorted(schools))
    else:
        tie = F.when(is_blank(F.col("evidence")), F.lit("evidence_span must be non-empty"))
    error = F.coalesce(
        F.when(is_blank(F.col("company_name")), F.lit("company_name must be non-empty")),
        tie,
        F.col("funding_error"),
        F.when(stage != "", not_allowed("funding_stage", stage, typing.STAGES)),
        F.col("exit_error"),
        F.col("employee_error"),
        not_allowed("status", F.col("status_value"), rules.STATUSES),
        not_allowed("validation_tier", F.col("validation_tier"), rules.TIERS),
    )
    return df.withColumn("error", error).withColumn("ok", F.col("error").isNull())


def heuristic_verify(df: DataFrame, cfg: Config) -> DataFrame:
    """Rule-based keep or remove with the reason."""
    out = df.withColumn("reason", rules.non_company_reason(F.col("company_name"), cfg))
    return out.withColumn("action", F.when(F.col("reason").isNull(), "keep").otherwise("remove"))


def ambiguous_records(df: DataFrame) -> DataFrame:
    return df.where(rules.ambiguous(F.col("founder"), F.col("evidence"), F.col("proof_url")))


def health_candidates(df: DataFrame) -> DataFrame:
    """Weak records that do have a proof url, with their number."""
    weak = df.where((F.col("validation_tier") == "weak") & ~is_blank(F.col("proof_url")))
    total = weak.agg(F.count("*")).scalar()
    return weak.select("company_name", "rec_seq").withColumn("total", total)


def list_records(
    df: DataFrame, tier: str | None = None, founded_after: int | None = None, limit: int | None = None
) -> DataFrame:
    """Records by tier and founding year in name order."""
    if tier is not None:
        df = df.where(F.col("validation_tier") == tier)
    if founded_after is not None:
        df = df.where(F.col("founded_year") >= founded_after)
    df = df.orderBy("company_name", "rec_seq")
    return df.limit(limit) if limit is not None else df

"""From flat records to typed records and affiliations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieproof.config import Config
from tieproof.functions import typing
from tieproof.functions.names import NOT_A_FOUNDER, lower_key, split_people
from tieproof.functions.text import cut, is_blank, once, strip, text
from tieproof.operators.enrich import migration_evidence

C = F.col


def with_people(df: DataFrame, cfg: Config) -> DataFrame:
    """Add ``evidence_all``, ``source`` and the list ``names`` a record stands for."""
    given = text(C("founder"))
    people = F.when((given == "") | F.lower(given).isin(*NOT_A_FOUNDER), text(C("founders"))).otherwise(given)
    usable = (strip(people) != "") & ~F.lower(strip(people)).isin(*NOT_A_FOUNDER)
    names = (
        F.when(usable, split_people(people))
        .when(~is_blank(C("evidence")), F.array(F.lit("(unspecified)")))
        .otherwise(F.array().cast("array<string>"))
    )
    proof = F.when(text(C("proof_url")) != "", C("proof_url")).when(text(C("source_url")) != "", C("source_url"))
    return df.withColumns({
        "evidence_all": migration_evidence(C("evidence"), C("description"), C("affiliation_type")),
        "names": names,
        "source": F.coalesce(proof, F.lit(cfg.fallback_proof_url)),
        "_named": usable,
    })


def affiliations(df: DataFrame, cfg: Config, max_chars: int | None = None) -> DataFrame:
    """One row per record and person with school, role, year and evidence (whole, or its first ``max_chars``)."""
    rows = with_people(df, cfg).select("*", F.posexplode("names").alias("pos", "person"))
    basis = F.when(C("_named"), C("evidence_all")).otherwise(text(C("evidence")))
    role_text = F.when(C("_named"), F.concat(C("evidence_all"), F.lit(" "), text(C("affiliation_type")))).otherwise(basis)
    span = F.when(basis != "", cut(basis, max_chars)).otherwise(F.concat("person", F.lit(" (migrated)")))
    return rows.select(
        "rec_seq", "company_name", "pos", "person",
        typing.school(basis, cfg.school_patterns, cfg.school_default).alias("school"),
        typing.person_role(role_text).alias("role"),
        typing.grad_year(basis).alias("grad_year"),
        F.when(C("_named"), typing.company_role(basis)).otherwise("founder").alias("role_at_company"),
        span.alias("evidence_span"),
        C("source").alias("source_url"),
    )


def migrate(df: DataFrame, cfg: Config) -> DataFrame:
    """Typed fields of every record and, where it cannot be kept, the reason."""
    rows = with_people(df, cfg)
    funding = C("funding_total_usd").cast("long")
    heads = typing.count_range(C("employees_text"))
    exit_raw = F.when(F.lower(strip(text(C("exit_year")))).isin("", *typing.MISSING_NUMBER), "").otherwise(C("exit_year"))
    exit_year = typing.year_typed(exit_raw)
    founded = typing.year_typed(C("founded_year").cast("string"))
    public = typing.bool3(C("is_public"))
    reason = F.coalesce(
        F.when(is_blank(C("company_name")), F.lit("no company_name")),
        F.when(F.size("names") == 0, F.lit("no parseable people")),
        *[F.concat(F.lit("validation: Value error, "), e) for e in (founded["error"], heads["error"], exit_year["error"])],
    )
    return rows.select(
        "rec_seq", "company_name", lower_key(C("company_name")).alias("key"),
        F.size("names").alias("n_people"),
        C("source").alias("proof_url"),
        F.when(text(C("description")) != "", C("description")).alias("description"),
        F.when(text(C("industry")) != "", C("industry")).alias("industry"),
        funding.alias("funding_total_usd"),
        typing.funding_stage(C("funding_stage")).alias("funding_stage"),
        founded["value"].alias("founded_year"),
        heads["value"].alias("employee_count"),
        public.alias("is_public"),
        "headquarters",
        typing.status(C("status_text"), public).alias("status"),
        exit_year["value"].alias("exit_year"),
        "acquirer", "acquisition_amount_usd", "validation_tier",
        once(reason).alias("reason"),
    )


def migrated(df: DataFrame, cfg: Config) -> DataFrame:
    """Records that pass, one per lower-case name; the later row wins."""
    ok = migrate(df, cfg).where("reason IS NULL").drop("reason")
    rest = [c for c in ok.columns if c != "key"]
    return ok.groupBy("key").agg(F.max_by(F.struct(*rest), "rec_seq").alias("_r")).select("key", "_r.*")


def reasons(df: DataFrame, cfg: Config) -> DataFrame:
    """Failure reasons, tiers, schools and roles of a migration, with counts."""
    m = migrate(df, cfg)
    passed = m.where("reason IS NULL")
    people = affiliations(df, cfg).join(passed.select("rec_seq"), "rec_seq", "left_semi")
    parts = [
        m.where("reason IS NOT NULL").select(F.lit("failure").alias("what"), C("reason").alias("value")),
        passed.select(F.lit("tier").alias("what"), C("validation_tier").alias("value")),
        people.select(F.explode(F.array(
            F.struct(F.lit("school").alias("what"), C("school").alias("value")),
            F.struct(F.lit("role").alias("what"), C("role").alias("value")),
        )).alias("_p")).select("_p.*"),
    ]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("what", "value").agg(F.count("*").alias("n"))



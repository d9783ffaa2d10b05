"""From model replies to evidence-checked records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieproof.config import Config
from tieproof.functions.names import name_key
from tieproof.functions.replies import typed_reply
from tieproof.functions.text import normalize_text, once, span_present, text
from tieproof.functions.urls import netloc, source_score

C = F.col
PERSON = "struct<name:string,school:string,role:string,role_at_company:string,grad_year:string,evidence_span:string>"
RECORD = f"struct<company_name:string,person:string,span:string,people:array<{PERSON}>>"


def records_of(payload: Column) -> Column:
    """The records of a JSON text: a list, lists under ``records``, or a single one; the text is parsed once."""
    either = RECORD.replace("struct<", f"struct<records:array<{RECORD}>,", 1)
    fields = ("company_name", "person", "span", "people")
    read = F.from_json(payload, f"array<{either}>")
    return F.flatten(F.transform(read, lambda r: F.coalesce(r["records"], F.array(F.struct(*[r[f].alias(f) for f in fields])))))


def people_of(record: Column) -> Column:
    """The people of a record; flat person fields count as one."""
    nothing = F.lit(None).cast("string")
    flat = F.struct(
        record["person"].alias("name"), nothing.alias("school"), nothing.alias("role"), nothing.alias("role_at_company"),
        nothing.alias("grad_year"), record["span"].alias("evidence_span"))
    return F.when(F.size(record["people"]) > 0, record["people"]).otherwise(F.array(flat))


def extract_gate(replies: DataFrame, cfg: Config) -> DataFrame:
    """Parsed records whose evidence occurs in their page, first per page and store key.

    People are gated one by one; a record stands with the people that do, if there
    is one. The page is normalised once for all of its claims, and its text ends
    before records become rows. ``replies``: ``doc_id, page_url, source_text,
    reply``, in order of ``doc_id``.
    """
    def has_name(b):
        return F.exists(records_of(b), lambda r: r["company_name"].isNotNull())

    parsed = replies.withColumn("_p", once(typed_reply(C("reply"), cfg.prompt_marker, has_name))).where("_p.payload IS NOT NULL")
    pages = parsed.select("doc_id", "page_url", once(normalize_text(C("source_text"))).alias("_page"),
                          once(records_of(C("_p.payload"))).alias("_rs"))

    def proven(person):
        span = normalize_text(person["evidence_span"])
        return (span != "") & F.contains(C("_page"), span)

    gated = F.transform("_rs", lambda r: F.struct(
        r["company_name"].alias("company_name"), F.filter(people_of(r), proven).alias("people")))
    rows = pages.select("doc_id", "page_url", F.posexplode(gated).alias("pos", "_r")).where(F.size("_r.people") > 0).select(
        "doc_id", "pos", "page_url", "_r.company_name", "_r.people", name_key(C("_r.company_name")).alias("name_key")
    ).where("name_key <> ''")
    first = rows.groupBy("page_url", "name_key").agg(
        F.min_by(F.struct("doc_id", "company_name", "people"), F.struct("doc_id", "pos")).alias("_r")
    )
    return first.select(
        "name_key", "_r.doc_id", "_r.company_name", F.get("_r.people", F.lit(0))["name"].alias("person"),
        F.size("_r.people").alias("n_people"), C("_r.people").alias("people"), C("page_url").alias("source_url"),
        source_score(C("page_url"), cfg.source_tiers, cfg.default_source_tier).alias("source_credibility"),
        netloc(C("page_url")).alias("source_domain"),
    )


# Fields that a second reply may give.
SECOND_FIELDS = (
    "description", "industry", "funding_total_usd", "funding_stage", "funding_last_round_year", "founded_year", "employee_count",
    "is_public", "headquarters", "status", "exit_year", "acquirer", "acquisition_amount_usd", "website_url",
    "linkedin_company_url", "crunchbase_url",
)


def second_pass(records: DataFrame, replies: DataFrame, fields=SECOND_FIELDS) -> DataFrame:
    """Apply the fields of a second reply that the records have.

    A value counts when it is not empty and its own span, if one is given,
    occurs in the page.
    """
    kinds = dict(records.dtypes)
    fields = [f for f in fields if f in kinds]
    schema = ", ".join(f"{f} string, {f}_evidence_span string" for f in fields)
    said = replies.select("doc_id", "source_text", F.from_json("reply", schema).alias("_r"))
    values = {}
    for f in fields:
        value, span = C("_r." + f), C(f"_r.{f}_evidence_span")
        proven = (text(span) == "") | span_present(span, C("source_text"))
        values["_" + f] = F.when((text(value) != "") & proven, value)
    applied = said.select("doc_id", *[c.alias(n) for n, c in values.items()])
    out = records.join(applied, "doc_id", "left")
    return out.withColumns({f: F.coalesce(C("_" + f).try_cast(kinds[f]), C(f)) for f in fields}).drop(*["_" + f for f in fields])

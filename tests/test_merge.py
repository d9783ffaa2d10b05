import random

import pytest
from pyspark.sql import functions as F

from tieproof.config import Config
from tieproof.operators import merge
from tieproof.plans import store

CFG = Config()
COLS = ("rec_seq long, company_name string, validation_tier string, proof_url string, description string, industry string, "
        "founded_year int, funding_total_usd long, employee_count int, status string")


def records(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_dedup_prefers_tier_then_order(spark):
    df = records(spark, [
        (1, "Acme Inc", "weak", "p1", "", "unknown", None, 5, None, "unknown"),
        (2, "The ACME", "high", "p2", None, "Bio", 0, 3, 10, "unknown"),
        (3, "acme (old)", "high", "p3", "d3", "Tech", 1999, None, 7, "active"),
        (4, "", "weak", "p4", "x", None, None, None, None, "ipo"),
        (5, "Inc.", "high", "p5", "y", None, None, None, None, "ipo"),
    ])
    rows = {r["rec_seq"]: r.asDict() for r in merge.dedup_merge(df).collect()}
    assert set(rows) == {2, 4, 5}
    acme = rows[2]
    assert (acme["company_name"], acme["proof_url"], acme["n_merged"]) == ("The ACME", "p2", 3)
    assert (acme["description"], acme["industry"], acme["founded_year"]) == ("d3", "Bio", 0)
    assert (acme["funding_total_usd"], acme["employee_count"], acme["status"]) == (5, 10, "active")
    issues = sorted(r["issue"] for r in merge.dedup_issues(df).collect())
    assert issues == ["deduped-with:Acme Inc", "deduped-with:acme (old)"]


def test_same_name_twice_is_noted(spark):
    df = records(spark, [(i, "Acme", "high", "", "", "", None, None, None, "x") for i in (1, 2)])
    assert [r["issue"] for r in merge.dedup_issues(df).collect()] == ["deduped-with:Acme"]


def test_people_union_first_wins(spark):
    df = records(spark, [(1, "Acme", "weak", "", "", "", None, None, None, ""), (2, "Acme Inc", "high", "", "", "", None, None, None, "")])
    people = spark.createDataFrame(
        [(1, 0, "Ann", "a"), (1, 1, "", "u1"), (2, 0, "Ann", "b"), (2, 1, "Bo", "c"), (2, 2, "", "u2")],
        "rec_seq long, pos int, person string, school string")
    got = {(r["person"], r["school"]) for r in merge.dedup_people(df, people).collect()}
    assert got == {("Ann", "b"), ("Bo", "c"), ("", "u2")}


FLAT = ("rec_seq long, company_name string, founder string, founders string, description string, affiliation_type string, "
        "evidence string, proof_url string, source_url string, status string, founded_year string, verified boolean")


def flat(spark, *rows):
    keys = [c.split()[0] for c in FLAT.split(", ")]
    base = dict(founder="Ann Lee", affiliation_type="Alumni", evidence="Ann Lee founded it in 1999",
                proof_url="https://a.org/x", verified=False)
    return spark.createDataFrame([tuple(dict(base, **r).get(k) for k in keys) for r in rows], FLAT)


def test_store_insert_fill_and_sources(spark):
    first = flat(spark, dict(rec_seq=1, company_name="Acme", source_url="https://s1", description=""))
    s, rows, _ = store.upsert(None, None, first, CFG)
    second = flat(spark, dict(rec_seq=1, company_name="ACME, Inc.", source_url="https://s2", description="Makes", status="active"))
    s2, rows2, clash = store.upsert(s.drop("validation_tier", "validation_issues"), rows, second, CFG)
    got = s2.collect()
    assert len(got) == 1 and got[0]["company_name"] == "Acme" and got[0]["description"] == "Makes"
    assert got[0]["n_sources"] == 2 and got[0]["verified"] and got[0]["validation_tier"] == "high"
    assert rows2.count() == 2 and clash.count() == 0


def test_store_gate(spark):
    batch = flat(
        spark, dict(rec_seq=1, company_name="Firm 3"), dict(rec_seq=2, company_name="Big Hackathon"),
        dict(rec_seq=3, company_name="Solo", founder=""), dict(rec_seq=4, company_name="Lic", founder="", affiliation_type="Licensed Tech"),
        dict(rec_seq=5, company_name="  "), dict(rec_seq=6, company_name="Ok"))
    s, _, _ = store.upsert(None, None, batch, CFG)
    assert sorted(r["company_name"] for r in s.collect()) == ["Lic", "Ok"]


def test_conflicts_keep_the_first(spark):
    df = flat(spark, dict(rec_seq=1, company_name="A", status="active", description=""),
              dict(rec_seq=2, company_name="A", status="acquired", description="d"),
              dict(rec_seq=3, company_name="A", status="unknown", description="d"),
              dict(rec_seq=4, company_name="A", status="acquired", description="e")).withColumn("name_key", F.lit("a"))
    got = {(r["field"], r["kept"], r["rejected"], r["n"]) for r in merge.conflicts(df).collect()}
    assert got == {("status", "active", "acquired", 2), ("description", "d", "e", 1)}


def test_unknown_fills_blank_only(spark):
    rows = [dict(rec_seq=1, company_name="A", founders=""), dict(rec_seq=2, company_name="A", founders="Unknown"),
            dict(rec_seq=3, company_name="A", founders="unknown")]
    df = flat(spark, *rows).withColumn("name_key", F.lit("a"))
    assert merge.upsert_merge(df).first()["founders"] == "unknown"
    more = flat(spark, *rows, dict(rec_seq=4, company_name="A", founders="Bo Park")).withColumn("name_key", F.lit("a"))
    assert merge.upsert_merge(more).first()["founders"] == "Bo Park"


def test_nested_layout_backfill(spark):
    df = spark.createDataFrame(
        [("", "", "", [("Ann Lee", "faculty", "span")]), ("Bo", "e", "Alumni", [("Ann Lee", "faculty", "span")])],
        "founder string, evidence string, affiliation_type string, people array<struct<name:string,role:string,evidence_span:string>>")
    got = [tuple(r)[:3] for r in merge.backfill_founder(df).collect()]
    assert got == [("Ann Lee", "span", "Faculty"), ("Bo", "e", "Alumni")]


def test_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(20_000).select(
        F.col("id").alias("rec_seq"), F.lit("Acme").alias("company_name"), F.lit("high").alias("validation_tier"),
        F.lit("").alias("proof_url"), F.lit("x").alias("status"))
    plan = merge.dedup_merge(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
    assert merge.dedup_merge(df).first()["n_merged"] == 20_000


@pytest.mark.parametrize("key", ["a", "b"])
def test_overlay(spark, key):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    patch = spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int")
    got = {r["k"]: (r["v"], r["origin"]) for r in merge.overlay(base, patch, "k").collect()}
    assert got == {"a": (1, "base"), "b": (9, "patch"), "c": (3, "patch")} and key in got


def test_merges_lose_no_column(spark):
    df = spark.createDataFrame(
        [(1, "Acme Inc", "weak", "", "unknown", "f1", 5.0, ["a", "b"], ["i1"], "s1", False),
         (2, "Acme", "high", "", "active", "", None, ["b", "c", ""], None, "s2", False)],
        "rec_seq long, company_name string, validation_tier string, proof_url string, status string, founder string, "
        "valuation_usd double, tags array<string>, validation_issues array<string>, source_url string, verified boolean")
    row = merge.dedup_merge(df).first()
    assert (row["founder"], row["valuation_usd"], row["source_url"]) == ("", None, "s2")  # of the base
    stored = merge.upsert_merge(df.withColumn("name_key", F.lit("acme"))).first()
    assert (stored["founder"], stored["valuation_usd"], stored["source_url"], stored["n_sources"]) == ("f1", 5.0, "s1", 2)
    lists = merge.united(df.withColumn("k", F.lit("acme")), "k", F.col("rec_seq")).orderBy("field", "first").collect()
    assert [(r["field"], r["value"]) for r in lists] == [("tags", "a"), ("tags", "b"), ("tags", "c"), ("validation_issues", "i1")]


def test_nested_records_are_stored(spark):
    batch = spark.createDataFrame(
        [(1, "Acme", None, None, None, "https://s", "https://a.org/x", False, "d", [("Ann Lee", "faculty", "span of evidence here")])],
        "rec_seq long, company_name string, founder string, evidence string, affiliation_type string, source_url string, proof_url string, "
        "verified boolean, description string, people array<struct<name:string,role:string,evidence_span:string>>")
    got = store.upsert(None, None, batch.withColumns({
        "founders": F.lit(""), "status": F.lit("unknown"), "founded_year": F.lit("")}), CFG)[0].first()
    assert (got["founder"], got["affiliation_type"], got["evidence"]) == ("Ann Lee", "Faculty", "span of evidence here")


def test_preferences_over_a_wide_order(spark):
    """Real values beat vague ones beat blanks, however far apart the places in the order are; null keys are a key."""
    far = 1 << 60
    df = spark.createDataFrame(
        [(None, far + 2, "Unknown", "s1", False), (None, 5, "", "s1", False), (None, far + 7, "real", None, False), (None, far + 8, "late", "", None),
         ("k", far + 1, "unknown", "s1", False), ("k", 3, "Unknown", "s2", False), ("k", 0, None, "s2", False), ("z", 1, "0", "", False)],
        "name_key string, rec_seq long, v string, source_url string, verified boolean")
    got = {r["name_key"]: (r["v"], r["n_sources"], r["verified"], r["rec_seq"]) for r in merge.upsert_merge(df).collect()}
    assert got == {None: ("real", 1, False, 5), "k": ("unknown", 2, True, 0), "z": ("0", 0, False, 1)}


def test_conflicts_are_those_of_a_walk_in_order(spark):
    rnd = random.Random(8)
    words = [None, "", "unknown", "0", "false", "Unknown", "a", "b", "c"]
    rows = [(rnd.choice([None, "k1", "k1", "k1", "k2", "k3"]), i, rnd.choice(words), rnd.choice(words), rnd.choice([None, 0, 1, 2])) for i in range(400)]
    want, kept = {}, {}
    for key, _, *cells in rows:
        for field, v in zip(("industry", "status", "founded_year"), cells):
            v = None if v is None else str(v)
            if key is None or v in (None, "", "unknown"):
                continue
            first = kept.setdefault((key, field), v)
            if v != first and not {v, first} & {"0", "false"}:
                want[key, field, first, v] = want.get((key, field, first, v), 0) + 1
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "name_key string, rec_seq long, industry string, status string, founded_year int")
    assert {tuple(r)[:4]: r["n"] for r in merge.conflicts(df).collect()} == want


def test_records_of_one_file_are_merged_by_many_tasks(spark):
    """A small file is one task; its records are spread before they are sorted or become a row a field."""
    df = spark.range(200).coalesce(1).select(
        F.concat(F.lit("k"), F.col("id") % 9).alias("name_key"), F.col("id").alias("rec_seq"), F.lit("x").alias("industry"),
        F.lit(True).alias("verified"))
    for out in (merge.merge_fields(df), merge.conflicts(df)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "RepartitionByExpression" in plan and plan.index("Aggregate") < plan.index("RepartitionByExpression")

import pytest
from pyspark.sql import functions as F

from tieproof.config import Config
from tieproof.functions import scoring
from tieproof.plans import gate

CFG = Config()


def score(spark, tier, n, api, tie, verdict):
    df = spark.range(1).select(scoring.score(
        F.lit(tier), F.lit(n), F.lit(api), F.lit(tie), F.lit(verdict).cast("string"), CFG).alias("s"))
    return df.first()["s"].asDict()


def test_directory_and_api(spark):
    s = score(spark, "directory", 2, True, "strong", "FOUNDER")
    assert s["confidence"] == 1.0 and s["publishable"]
    assert s["provenance"] == ["directory-source", "api-confirmed", "corroborations=2", "strong-tie", "verdict-founder",
                               "structured-agreement"]


def test_thin_sources_stay_below(spark):
    s = score(spark, "mention", 1, False, "weak", None)
    assert s == {"confidence": 0.0, "publishable": False, "provenance": []}
    assert score(spark, "directory", 1, False, "weak", "FOUNDER")["publishable"]


def test_two_authorities_lift_to_the_threshold(spark):
    s = score(spark, "mention", 2, True, "weak", None)
    assert s["confidence"] == 0.7 and s["publishable"]


@pytest.mark.parametrize("founder, evidence, ok", [
    ("Kim Solano", "the founder Omar Pratt of the firm", False),
    ("Omar Pratt", "founded by Omar Lee Pratt", True),
    ("Kim Solano", "worked on the protocol", True),
    ("Kim Solano", "founder X. Later Solano joined", True),
    ("", "founder X", True), (None, None, True),
])
def test_contradiction(value, founder, evidence, ok):
    assert value(scoring.consistent, founder, evidence) is ok


def decide(spark, verdict, real, entity, tie, confidence, contradiction):
    c = scoring.decide(F.lit(verdict).cast("string"), F.lit(real).cast("boolean"), F.lit(entity).cast("string"), F.lit(tie),
                       F.lit(confidence), F.lit(contradiction), CFG)
    d = spark.range(1).select(c.alias("d")).first()["d"]
    return d["state"], d["reason"]


def test_decision_order(spark):
    assert decide(spark, "FOUNDER", False, "fund", "none", 1.0, True) == ("needs_human", "founder/evidence contradiction")
    assert decide(spark, "FOUNDER", None, "investment_fund", "strong", 1.0, False) == ("rejected", "not-a-company (investment_fund)")
    assert decide(spark, "FOUNDER", True, "company", "none", 1.0, False) == ("rejected", "no institution tie")
    assert decide(spark, "EXECUTIVE", True, "company", "weak", 1.0, False) == ("rejected", "role=executive")
    assert decide(spark, None, None, "unknown", "weak", 0.7, False) == ("verified", "founding confirmed")
    assert decide(spark, "UNCLEAR", None, "unknown", "weak", 0.9, False) == ("needs_human", "insufficient confidence (0.9)")
    assert decide(spark, "FOUNDER", None, "unknown", "strong", 0.45, False)[0] == "needs_human"


def gate_one(spark, record, verdict=None, recovery=None, edge=None, registry=None):
    cols = ("company_name", "founder", "evidence", "proof_url", "affiliation_type")
    records = spark.createDataFrame([tuple(record.get(c) for c in cols)], ", ".join(f"{c} string" for c in cols))
    log = "seq long, company_name string, verdict string"
    name = record["company_name"]
    verdicts = spark.createDataFrame([(1, name, "EMPLOYEE"), (2, name, verdict)] if verdict else [], log)
    second = spark.createDataFrame([(1, name, recovery)] if recovery else [], log)
    edges = spark.createDataFrame([(name, edge)] if edge else [], "company string, founder string")
    reg = spark.createDataFrame([(name.lower(), 1, registry)] if registry else [], "lookup_name string, reg_seq long, detail string")
    rows = gate.gate(records, verdicts, second, edges, reg, CFG).collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_recovery_overrides_and_graph_confirms(spark):
    row = gate_one(spark, dict(company_name="Lava", founder="Omar Lee Pratt", evidence="co-founded", proof_url="https://news.example.org/x",
                               affiliation_type="Alumnus"), "UNCLEAR", "FOUNDER", edge="O. Pratt")
    assert row["state"] == "verified" and row["confidence"] >= 0.7 and "api-confirmed" in row["provenance"]
    assert row["entity_verified"] is True and "graph" in row["entity_note"]


def test_unproven_entity_is_no_reason_to_reject(spark):
    row = gate_one(spark, dict(company_name="Stealth", founder="Jane Doe", evidence="founded by Jane Doe",
                               proof_url="https://list.example.org/x", affiliation_type="Alumnus"), "FOUNDER")
    assert row["state"] == "verified" and row["entity_verified"] is None and "UNVERIFIED" in row["entity_note"]
    assert row["confidence_provenance"] == "0.90 | directory-source; strong-tie; verdict-founder"


def test_executives_stay_out(spark):
    row = gate_one(spark, dict(company_name="Borough", founder="Dana Marlow", evidence="former chairman", proof_url="x",
                               affiliation_type="Alumnus"), "EXECUTIVE", registry="Borough / US / 1")
    assert row["state"] == "rejected" and row["entity_note"] == "entity confirmed (registry)"

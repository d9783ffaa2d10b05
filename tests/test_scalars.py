import pytest
from pyspark.sql import functions as F

from tieproof.config import Config
from tieproof.functions import names, rules, typing, urls
from tieproof.functions.text import normalize_text, quoted, span_present

CFG = Config()


@pytest.mark.parametrize("raw, key", [
    ("Acme, Inc.", "acme"), ("Acme LLC", "acme"), (" The  Firm 1 ", "the firm 1"), ("Firm 1 (x)", "firm 1 x"),
    ("Ünit Corp.", "ünit"), ("plc", ""), ("", ""), (None, ""),
])
def test_store_key(value, raw, key):
    assert value(names.name_key, raw) == key


@pytest.mark.parametrize("raw, key", [
    ("The Firm 1", "firm 1"), ("Firm 1 (formerly X)", "firm 1"), ("Acme Holdings Company", "acme"),
    ("A.B. Labs l.l.c.", "a b l l c"), (None, ""), ("Inc.", ""),
])
def test_canonical_name(value, raw, key):
    assert value(names.canonical_name, raw) == key


def test_keys_stay_apart(value):
    raw = "The Acme Systems"
    assert value(names.canonical_name, raw) == "acme"
    assert value(names.canonical_name_short, raw) == "acme systems"
    assert value(names.name_key, raw) == "the acme systems"


@pytest.mark.parametrize("raw, ok", [
    ("Dana Marlow", True), ("Émile Zola", True), ("Unknown", False), ("madonna", False), ("Ann lee", False),
    ("Various", False), ("", False), ("O'Neil Smith-Jones", True), ("Ann\tLee", False),
])
def test_human_name(value, raw, ok):
    assert value(names.is_human_name, raw) is ok


def test_split_people(value):
    assert value(names.split_people, "Ann Lee and Bo Park & Cy; unknown, X") == ["Ann Lee", "Bo Park", "Cy"]


@pytest.mark.parametrize("raw, want", [
    ("https://x.com/a?utm_source=foo&id=1", "https://x.com/a?id=1"),
    ("https://x.com/?utm_medium=a&utm_campaign=b&fbclid=c&gclid=d&id=1", "https://x.com/?id=1"),
    ("HTTPS://EXAMPLE.COM/Path", "https://example.com/Path"),
    ("https://example.com/", "https://example.com"),
    ("https://en.wikipedia.org/wiki/Dana_Marlow", "https://en.wikipedia.org/wiki/Dana_Marlow"),
    ("no scheme", "no scheme"), (None, None),
    ("https://x.com/a?b=&q=a+b%2Fc&UTM_Source=1", "https://x.com/a?b=&q=a+b%2Fc"),
    ("https://x.com/a?q=~*#top", "https://x.com/a?q=~%2A#top"),
    ("https://x.com/a?q=100%zz", "https://x.com/a?q=100%25zz"),
    ("https://x.com/a?flag", "https://x.com/a?flag="),
])
def test_canonical_url(value, raw, want):
    assert value(urls.canonicalize_url, raw) == want


@pytest.mark.parametrize("raw, want", [
    ("https://www.Example.org:80/x", "example.org:80"), ("http://a.www.b.c/", "a.b.c"), ("x.y/z", ""), (None, ""),
])
def test_domain(value, raw, want):
    assert value(urls.domain, raw) == want


def test_url_test(value):
    assert value(urls.is_url, "https://a.b/c") and not value(urls.is_url, "ftp://a.b") and not value(urls.is_url, "http://example.com/x")


@pytest.mark.parametrize("raw, amount", [
    ("$12M", 12_000_000), ("1.2B", 1_200_000_000), ("12.5 million", 12_500_000), ("-5", 5), ("1,250,000", 1_250_000),
    ("500k raised", 500_000),
])
def test_money_typed(value, raw, amount):
    assert value(typing.money_typed, raw) == {"value": amount, "error": None}


def test_money_typed_error(value):
    assert value(typing.money_typed, "lots") == {"value": None, "error": "cannot parse money: 'lots'"}
    assert value(typing.money_typed, "") == {"value": None, "error": None}


@pytest.mark.parametrize("raw, amount, issue", [
    ("$12M", 12e6, None), ("12.5 million", 12.5e6, None), ("~1.2B", 1.2e9, None), ("approx 300k", 3e5, None),
    ("", None, None), ("Unknown", None, None), (None, None, None), ("2 thousand", 2e3, None),
    ("5million", None, "could not parse funding_total_usd: '5million'"),
    ("7 trillion", None, "funding_total_usd out of plausible range: 7000000000000.0"),
    ("-3", None, "funding_total_usd out of plausible range: -3.0"),
    ("it's", None, 'could not parse funding_total_usd: "it\'s"'),
])
def test_money_lenient(value, raw, amount, issue):
    assert value(typing.money_lenient, raw) == {"value": amount, "issue": issue}


def test_years(value):
    assert value(typing.year_lenient, "1750")["issue"] == "year out of plausible range (1800-2030): 1750"
    assert value(typing.year_typed, "1750") == {"value": 1750, "error": None}
    assert value(typing.year_lenient, "12.0")["issue"] == "unparseable year: '12.0'"
    assert value(typing.grad_year, "graduated in 1999, then 2005") == 1999


@pytest.mark.parametrize("raw, n", [("51-200", 125), ("25+", 25), ("5,000-10,000", 7500), ("12", 12), ("n/a", None), ("1 to 4", 2)])
def test_count_range(value, raw, n):
    assert value(typing.count_range, raw) == {"value": n, "error": None}


def test_closed_vocabularies(value):
    assert value(typing.funding_stage, "Series A") == "series-a" and value(typing.funding_stage, "late") is None
    assert value(typing.bool3, "Y") is True and value(typing.bool3, "maybe") is None
    assert value(typing.person_role, "Associate Professor of X") == "faculty"
    assert value(typing.company_role, "co-founder and CEO") == "cofounder"
    assert value(lambda c: typing.http_class(c.cast("int")), "429") == "long_backoff"
    assert value(lambda c: typing.http_class(c.cast("int")), "301") == "retryable"


def test_source_score_takes_the_longest(value):
    score = lambda c: urls.source_score(c, {".org": 4, "list.example.org": 2}, 3)
    assert value(score, "https://list.example.org/x") == 2
    assert value(score, "https://other.org/") == 4 and value(score, "https://x.com") == 3


def test_evidence(value):
    assert value(normalize_text, "Dana   Marlow\n\n(Class '55)") == "dana marlow (class '55)"
    assert value(span_present, "dana MARLOW", "founded by Dana\u00a0\nMarlow in 1962")
    assert not value(span_present, "Dana Marlow", "Bob Smith founded the firm")
    assert not value(span_present, "  ", "anything")


def test_quoted(value):
    assert value(quoted, "a") == "'a'" and value(quoted, "a'b") == '"a\'b"' and value(quoted, "'\"") == "'\\'\"'"


def test_non_company(value):
    reason = lambda c: rules.non_company_reason(c, CFG)
    assert value(reason, "Firm 3, Inc.").startswith("blocklisted")
    assert value(reason, "Venture in Formation 2").startswith("placeholder entry")
    assert "program" in value(reason, "Upstate Angel Group")
    assert value(reason, "Acme") is None


def test_triage_order(value):
    t = lambda n, f, e: rules.triage(n, f, e, CFG)
    assert value(t, "Firm 1 Ventures", "", "founded")["bucket"] == "reject:own-entity"
    assert value(t, "Acme Ventures", "", "founded")["reason"].endswith("'Ventures'")
    assert value(t, "Acme", "A B", "joined as analyst")["bucket"] == "reject:employment"
    assert value(t, "Acme", "A B", "joined, then co-founded")["bucket"] == "keep:founding-language"
    assert value(t, "Acme", "A B", "class of 2009")["bucket"] == "review:no-founding"


def test_validation(spark):
    row = dict(company_name="Acme", founder="Ann Lee", founders="Ann Lee, various", proof_url="https://en.wikipedia.org/wiki/A",
               evidence="Ann Lee founded Acme in 1999", affiliation_type="Alumni", funding_total_usd="$2M", founded_year="1700")
    good = dict(row, founders="Ann Lee", founded_year="1999")
    single = dict(good, proof_url="https://a.org/x", source_credibility="1")
    weak = dict(good, founder="")
    licensed = dict(good, founder="", affiliation_type="Licensed Tech")
    cols = list(dict(row, source_credibility=""))
    df = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in (row, good, single, weak, licensed)],
                               ", ".join(f"{c} string" for c in cols))
    out = [r.asDict() for r in rules.validate(df, CFG).collect()]
    assert [r["validation_tier"] for r in out] == ["provisional", "high", "provisional", "weak", "high"]
    assert out[0]["validation_issues"] == [
        "founded_year: year out of plausible range (1800-2030): 1700",
        "founders contain non-name tokens: ['various']",
    ]
    assert out[0]["founded_year"] is None and out[1]["funding_total_usd"] == 2e6
    assert out[2]["validation_issues"][0].startswith("single-source from low-credibility")
    assert out[3]["validation_issues"] == ["missing founder (required unless Licensed Tech)"]
    two = df.limit(0).union(df.where(F.col("source_credibility") == "1")).withColumn("n_sources", F.lit(2))
    assert rules.validate(two, CFG).first()["validation_tier"] == "high"

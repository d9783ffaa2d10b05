import json

import pytest
from pyspark.sql import functions as F

from tieproof.config import Config
from tieproof.functions import pages, replies

MARK = Config().prompt_marker


def has_records(b):
    return F.from_json(b, "records array<struct<company_name:string>>, notes string")["records"].isNotNull()


def parse(value, text):
    return value(lambda c: replies.typed_reply(c, MARK, has_records), text)


GOOD = '{"records": [{"company_name": "Borough"}], "notes": ""}'


@pytest.mark.parametrize("text, outcome", [
    (GOOD, "parsed"),
    ("Here:\n```json\n" + GOOD + "\n```\nbye", "fence_extracted"),
    ("prompt ```json\n{}\n``` " + MARK + GOOD, "marker_sliced"),
    ("JSON" + GOOD + "\nLet me know {if} more", "payload_extracted"),
    ("not even json", "schema_invalid"), ("JSON{\"x\": 1}", "schema_invalid"), ("  ", "empty"), (None, "empty"),
])
def test_typed_outcomes(value, text, outcome):
    got = parse(value, text)
    assert got["outcome"] == outcome
    assert (got["payload"] is not None) == (outcome not in ("schema_invalid", "empty"))


def test_largest_fitting_fence_wins(value):
    text = "```json\n{\"long\": \"" + "x" * 200 + "\"}\n```\n```\n" + GOOD + "\n```"
    assert json.loads(parse(value, text)["payload"])["records"] == [{"company_name": "Borough"}]


@pytest.mark.parametrize("text, span", [
    ('a {"k": "}]", "l": [1]} b', '{"k": "}]", "l": [1]}'), ('[{"a": "\\"]"}] x', '[{"a": "\\"]"}]'),
    ('{"open": [1, 2', '{"open": [1, 2'), ("none", None), ("", None), (None, None),
])
def test_balanced_span(text, span):
    assert replies.balanced_span(text) == span


def test_quote_repair(value):
    fix = lambda t: value(replies.repair_quotes, t)
    assert json.loads(fix('[\n""Mamba" site:x organization"\n]')) == ['"Mamba" site:x organization']
    fixed = json.loads(fix('{\n"founders": "Omar, Theo "Tip" Ray",\n"ok": true\n}'))
    assert fixed == {"founders": 'Omar, Theo "Tip" Ray', "ok": True}
    for clean in ('{\n"company_name": "Acme",\n"ok": true\n}', '"a": "b\\"c"', "", "no quotes", '"k": "three" bare"'):
        assert fix(clean) == clean
    assert fix('  "k" : x "a \\"b\\" "c" d" , y') == '  "k" : x "a \\"b\\" \\"c\\" d" , y'


def test_untyped_search(value):
    find = lambda t, expect: value(lambda c: replies.recover_json(c, expect), t)
    prose = 'Here is my analysis.\n\n{\n"thinking": "t",\n"actions": [{"type": "d"}]\n}\n'
    assert json.loads(find(prose, "object"))["thinking"] == "t"
    assert json.loads(find(prose, "any")) == [{"type": "d"}]
    assert find("[1, 2, 3]", "object") is None and find("[1, 2, 3]", "array") == "[1, 2, 3]" and find(None, "any") is None
    broken = 'plan:\n[\n{\n"queries": [\n""Liquid" founder "C""\n]\n}\n]\n'
    assert json.loads(find(broken, "any"))[0]["queries"] == ['"Liquid" founder "C"']


def test_echo_codes_and_tokens(value):
    prompt = "p" * 300 + " tail of the prompt"
    assert value(replies.is_echo, "You said: " + prompt, prompt) and not value(replies.is_echo, "fine", prompt)
    got = value(replies.code_tokens, "0:F 1: E 2:Q 12:U 3:NN")
    assert [(t["idx"], t["verdict"]) for t in got] == [(0, "FOUNDER"), (1, "EMPLOYEE"), (12, "UNCLEAR")]
    assert value(replies.one_token_verdict, " founder ") == "FOUNDER" and value(replies.one_token_verdict, "x" * 20 + "FOUNDER") == "NOT"


def test_page_text():
    html = ("<html><head><title>T &amp; U</title></head><body><nav>skip</nav><p>before</p><main><h1>Head</h1>"
            "<p>One < two<br>three<script>no()</script></p><!-- c --><div>" + "word " * 20 + "</div></main><p>after</p></body></html>")
    text, status = pages.page_text(html, "http://u")
    assert status == "ok"
    assert text == "[Page title: T & U]\n[URL: http://u]\n\nHead\nOne < two\nthree\n" + ("word " * 20).strip()
    assert pages.page_text("<p>no container</p>", "u") == ("", "empty")
    assert pages.page_text("<body>short</body>", "u") == ("", "empty")
    assert pages.page_text(None, "u") == ("", "empty")


def test_first_article_beats_main():
    html = "<main>outer " + "m " * 40 + "</main><article>inner " + "a " * 40 + "</article><article>late</article>"
    assert pages.page_text(html, "u")[0].startswith("inner")


def test_embedded_address_is_near_the_flag(value):
    far = '"city":"Far"' + " " * 900
    html = far + '{"city":"Near","country":"US"},"headquarter" : true'
    get = lambda k: value(lambda c: pages.embedded_fields(c)[k], html)
    assert get("hq_city") == "Near" and get("hq_country") == "US" and get("hq_region") is None
    assert value(lambda c: pages.embedded_fields(c)["company_url"], '"url":"https://www.linkedin.com/x","url":"https://a.b/"') == "https://a.b/"


def test_records_of_every_layout_are_gated_by_person(spark):
    from tieproof.config import Config
    from tieproof.plans.extract import extract_gate

    good, bad = "Ann Lee founded  Acme", "never said"
    person = lambda n, s: {"name": n, "evidence_span": s}
    acme = {"company_name": "Acme", "people": [person("Bo", bad), person("Ann", good), person("Cy", good)]}
    none = {"company_name": "Nobody", "people": [person("Bo", bad)]}
    said = [acme, [none, acme], {"records": [acme, dict(acme, company_name="Beta")]}, {"company_name": "Flat", "person": "Ann", "span": good},
            [none], {"records": []}, "text"]
    rows = [(i, f"https://p{i}.org/", "x ann lee FOUNDED acme y", json.dumps(s)) for i, s in enumerate(said)]
    df = spark.createDataFrame(rows, "doc_id long, page_url string, source_text string, reply string")
    got = {(r["doc_id"], r["company_name"], tuple(p["name"] for p in r["people"])) for r in extract_gate(df, Config()).collect()}
    both = ("Ann", "Cy")
    assert got == {(0, "Acme", both), (1, "Acme", both), (2, "Acme", both), (2, "Beta", both), (3, "Flat", ("Ann",))}


def test_records_of_mixed_layouts(spark):
    """Records beside and under ``records`` both count; fields of another kind are null."""
    from tieproof.plans.extract import records_of

    cases = {
        '[{"records":[{"company_name":"A"}]},{"company_name":"C"}]': ["A", "C"], '{"records":null,"company_name":"Q"}': ["Q"],
        '[{"company_name":"A","records":"x"},{"company_name":"B"}]': ["A", "B"], '{"records":[]}': [], "[]": [], "{}": [None],
        '{"records":[{"company_name":5,"people":"x"}]}': ["5"], "[1,2]": None, "x": None, "": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "p string")
    got = {r["p"]: r["n"] for r in df.select("p", records_of(F.col("p"))["company_name"].alias("n")).collect()}
    assert got == cases

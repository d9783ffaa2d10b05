"""Url rules against a plain loop."""

import re

from tieproof.llm.url_filter import RULES, judge

URLS = [
    None, "", "example.com/en/1", "http://", "https://WWW.Example.com/en/1?x=1#y", "http://example.com/en/", "http://example.com/en",
    "http://a.b.example.com/en/x/y.html", "http://notexample.com/en/", "http://com/", "http://com", "http://x.net/es/", "http://net/fr/a",
    "http://x.net/de/", "ftp://x.net?/es/", "http://x.com#/en/", "http://a://b.com/en/", "http://.com/", "http://x.com//en/",
    "http://www.example.com/EN/", "http://ÄÖ.com/ä/", "http://x.net/es", "http://example.com/en/\nzwei", "http://h.com/" + "a/" * 300,
]


def plain(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, default))
    return host, path, best[1], best[2]


def check(spark, rules, rows):
    pages = spark.createDataFrame([(i, u, "r", "h") for i, u in rows], "page_id long, url string, rule string, host string")
    got = judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, *plain(u, rules)) for i, u in rows), key=repr)


def test_rules_of_the_query(spark):
    check(spark, list(RULES), list(enumerate(URLS)) + [(4, URLS[4]), (4, URLS[4])])


def test_paths_without_final_slash_and_no_path(spark):
    rules = [("example.com", "/e", "block"), ("www.example.com", "", "allow"), ("x.net", "/es/", "block"), ("x.net", "/es/", "block")]
    check(spark, rules, list(enumerate(URLS)))


def test_long_urls_and_rules_of_many_depths(spark):
    rules = [("com", "/", "block"), ("com", "/a/a/", "allow"), ("h.com", "/a/a/a/b", "block"), ("x.h.com", "/a", "allow"),
             ("h.com", "//", "block"), ("h.com", "", "allow"), ("d." * 5 + "com", "/a/", "block")]
    paths = ["", "/", "/a", "/a/", "/a/a/", "/a/a/a/b", "/a/a/a/bc/d", "/a/a/a/a/b", "//", "///", "/a" * 20_000, "/a/a/a/b" + "/" * 20_000]
    hosts = ["h.com", "x.h.com", "y.x.h.com", "d." * 5 + "com", "e." * 3_000 + "h.com", "com"]
    check(spark, rules, list(enumerate(f"http://{h}{p}" for h in hosts for p in paths)))


def test_empty(spark):
    check(spark, list(RULES), [])
    check(spark, [], [(1, "http://x.com/")])


def test_plan_has_no_python(spark, capsys):
    pages = spark.createDataFrame([(1, "http://x.com/")], "page_id long, url string")
    judge(pages, spark.createDataFrame(list(RULES), "host string, path string, verdict string")).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan

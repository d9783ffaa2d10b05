"""URL clean-up and host rules, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tieproof.functions.text import strip, text

# Query parameters that only track the visitor.
TRACKING = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "fbclid", "gclid", "mc_cid", "mc_eid", "ref",
)
# Hosts that are placeholders.
NOT_A_HOST = ("example.com", "localhost", "n/a", "unknown")

SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
NETLOC = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)"


def netloc(c: Column) -> Column:
    """Authority part, as written, with port and user; empty when there is none."""
    return F.regexp_extract(text(c), NETLOC, 1)


def domain(c: Column) -> Column:
    """Lower-case host with every ``www.`` taken out."""
    return F.replace(F.lower(netloc(c)), F.lit("www."), F.lit(""))


def _reencode(c: Column) -> Column:
    """Decode a form value and encode it again in one spelling."""
    safe = F.regexp_replace(c, r"%(?![0-9A-Fa-f]{2})", "%25")
    once = F.url_encode(F.coalesce(F.try_url_decode(safe), c))
    return F.replace(F.replace(once, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _clean_query(query: Column) -> Column:
    def one(pair: Column) -> Column:
        key = F.regexp_extract(pair, "^([^=]*)", 1)
        value = F.regexp_extract(pair, "^[^=]*=(.*)$", 1)
        return F.struct(
            F.lower(F.coalesce(F.try_url_decode(key), key)).alias("k"),
            F.concat(_reencode(key), F.lit("="), _reencode(value)).alias("kv"),
        )

    pairs = F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), one)
    kept = F.filter(pairs, lambda p: ~p["k"].isin(*TRACKING))
    return F.array_join(F.transform(kept, lambda p: p["kv"]), "&")


def canonicalize_url(c: Column) -> Column:
    """Lower scheme and host, drop tracking parameters and a lone root path."""
    u = strip(c)
    scheme = F.lower(F.regexp_extract(u, SCHEME, 1))
    host = F.lower(netloc(u))
    has_host = u.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*://")
    path = F.regexp_extract(u, r"^[a-zA-Z][a-zA-Z0-9+.\-]*:(?://[^/?#]*)?([^?#]*)", 1)
    query = _clean_query(F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1))
    fragment = F.regexp_extract(u, r"^[^#]*#(.*)$", 1)
    lone_root = path.rlike(r"^/(?:;[^/]*)?$") & (query == "") & (fragment == "")
    return F.when(scheme == "", c).otherwise(
        F.concat(
            scheme,
            F.when(has_host, F.concat(F.lit("://"), host)).otherwise(F.lit(":")),
            F.when(lone_root, F.lit("")).otherwise(path),
            F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)),
            F.when(fragment == "", F.lit("")).otherwise(F.concat(F.lit("#"), fragment)),
        )
    )


def is_url(c: Column) -> Column:
    u = strip(text(c))
    host = netloc(u)
    return u.rlike(r"^(?i:https?):") & F.contains(host, F.lit(".")) & ~F.lower(host).isin(*NOT_A_HOST)


def source_score(url: Column, tiers: dict[str, int], default: int = 2) -> Column:
    """Credibility of the longest pattern found in the host."""
    host = F.lower(netloc(url))
    score = F.lit(default)
    for pattern, tier in sorted(tiers.items(), key=lambda kv: len(kv[0])):
        score = F.when(F.contains(host, F.lit(pattern)), F.lit(tier)).otherwise(score)
    return score


def url_key(c: Column) -> Column:
    """File name stem under which a page is cached."""
    return F.substring(F.sha2(c, 256), 1, 16)

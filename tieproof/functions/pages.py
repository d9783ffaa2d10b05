"""Web pages: text out of HTML, wall flags, links and embedded organisation data."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieproof.functions.text import cut, strip, text

# Tags whose content is never page text.
DROPPED_TAGS = {
    "script", "style", "nav", "footer", "header", "aside", "form", "noscript", "iframe", "svg", "button", "input", "select", "textarea",
}
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Hosts that are no result of a search.
LINK_DENY = ("google.com", "google.", "gstatic", "googleapis", "youtube.com", "webcache")

# Wall and field patterns of a fetched page.
AUTH_WALL = (
    r"(sign in to view|sign in for the full|join now to see|"
    r"we want to make sure it's you|join linkedin)"
)
CAPTCHA = r"(captcha|are you a robot|verify (?:you are|that you))"
PAGE_FIELDS = {
    "page_title": r"<title[^>]*>([^<]+)</title>",
    "og_description": r'<meta[^>]+(?:name|property)="(?:og:description|description)"[^>]+content="([^"]+)"',
    "founded_year": r"\bFounded\b\s*[:\-]?\s*(\d{4})",
    "employees_signal": r"(\d[\d,]*(?:\+| ?(?:employees|people on linkedin)))",
    "hq_signal": r"\b(?:Headquarter(?:s|ed)|Based in)\s*[:\-]?\s*([^\n<]{4,120})",
}
PROFILE_FIELDS = {
    "title": r"<title[^>]*>([^<]+)</title>",
    "og_description": r'<meta[^>]+property="og:description"[^>]+content="([^"]+)"',
    "founded_year": r"\bFounded\b\s*[:\-]?\s*(\d{4})",
    "employees_exact": r"(\d{1,3}(?:,\d{3})+|\d{2,7})\s+employees?",
    "headquarters": r"\bHeadquarters\b\s*[:\-]?\s*([^\n<]{4,150})",
    "specialties": r"\bSpecialties\b\s*[:\-]?\s*([^\n<]{4,400})",
    "website": r'href="(https?://[^"]+)"[^>]*>\s*<span[^>]*>\s*Website',
    "industry": r"\bIndustry\b\s*[:\-]?\s*([^\n<]{4,80})",
    "company_size": r"\bCompany size\b\s*[:\-]?\s*([^\n<]{4,80})",
}
PROFILE_TYPE = r"\bType\b\s*[:\-]?\s*([A-Z][^\n<]{3,60})"
# Fields of the data a company page embeds.
EMBEDDED_FIELDS = {
    "employee_count": r'"employeeCount"\s*:\s*(\d{1,8})\b',
    "follower_count": r'"followerCount"\s*:\s*(\d{1,9})\b',
    "staff_count_range": r'"staffCountRange"\s*:\s*"([A-Z0-9_]+)"',
    "founded_year": r'"foundedOn"\s*:\s*\{\s*[^\}]*?"year"\s*:\s*(\d{4})',
    "tagline": r'"tagline"\s*:\s*"([^"]{1,300})"',
    "name": r'"name"\s*:\s*"([^"]{1,200})"\s*,\s*"tagline"',
    "website": r'"companyPageUrl"\s*:\s*"(https?://[^"@]+)"',
    "company_url": r'"url"\s*:\s*"(https?://(?!www\.linkedin)[^"@]+)"',
    "specialities": r'"specialities"\s*:\s*\[("[^\]]{0,2000})\]',
}
ADDRESS_FIELDS = {
    "hq_city": r'"city"\s*:\s*"([^"]+)"',
    "hq_region": r'"geographicArea"\s*:\s*"([^"]+)"',
    "hq_country": r'"country"\s*:\s*"([A-Z]{2,3})"',
    "hq_postal": r'"postalCode"\s*:\s*"([^"]+)"',
    "hq_line1": r'"line1"\s*:\s*"([^"]+)"',
}
HQ_FLAG = r'"headquarter"\s*:\s*true'
JSONLD_SCRIPT = r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'
ORGANIZATION_TYPES = ("Organization", "Corporation", "EducationalOrganization", "CollegeOrUniversity")


class _PageText(HTMLParser):
    """Collects the text of the candidate containers of one page in a single pass."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.in_title = [], False
        self.dropped = 0
        self.pending: list[str] = []
        self.open_tags: list[tuple[str, str | None]] = []
        self.taken: dict[str, list[str]] = {}
        self.closed: set[str] = set()

    @staticmethod
    def _container(tag, attrs):
        if tag in ("article", "main", "body"):
            return tag
        if tag == "div" and dict(attrs).get("role") == "main":
            return "role"
        return None

    def _flush(self):
        """End of a run of text: one piece, however many events it came in."""
        run, self.pending = "".join(self.pending), []
        if self.in_title:
            self.title.append(run)
        piece = run.strip()
        if piece and not self.dropped:
            for kind, pieces in self.taken.items():
                if kind not in self.closed:
                    pieces.append(piece)

    def handle_starttag(self, tag, attrs):
        self._flush()
        if tag in VOID_TAGS:
            return
        if tag == "title" and not self.title:
            self.in_title = True
        if tag in DROPPED_TAGS:
            self.dropped += 1
        kind = self._container(tag, attrs) if not self.dropped else None
        if kind in self.taken:
            kind = None
        if kind:
            self.taken[kind] = []
        self.open_tags.append((tag, kind))

    def handle_endtag(self, tag):
        self._flush()
        if tag == "title":
            self.in_title = False
        if not any(t == tag for t, _ in self.open_tags):
            return
        while self.open_tags:
            name, kind = self.open_tags.pop()
            if name in DROPPED_TAGS:
                self.dropped -= 1
            if kind:
                self.closed.add(kind)
            if name == tag:
                break

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self._flush()

    def close(self):
        super().close()
        self._flush()


def page_text(html: str, url: str, max_chars: int | None = None) -> tuple[str, str]:
    """(text, "ok" | "empty") of one page."""
    parser = _PageText()
    parser.feed(html or "")
    parser.close()
    pieces = next((parser.taken[k] for k in ("article", "main", "role", "body") if k in parser.taken), None)
    if pieces is None:
        return "", "empty"
    body = re.sub(r"\n{3,}", "\n\n", "\n".join(pieces))
    if max_chars is not None:
        body = body[:max_chars]
    if len(body) < 50:
        return "", "empty"
    title = "".join(parser.title).strip()
    return (f"[Page title: {title}]\n[URL: {url}]\n\n{body}" if title else body), "ok"


def html_to_text(df: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Add ``text`` and ``status`` to a table with ``page_id, url, html``; one narrow map."""

    def convert(batches):
        for pdf in batches:
            pairs = [page_text(h, u, max_chars) for h, u in zip(pdf["html"], pdf["url"])]
            yield pd.DataFrame({
                "page_id": pdf["page_id"],
                "url": pdf["url"],
                "text": [p[0] for p in pairs],
                "status": [p[1] for p in pairs],
            })

    return df.select("page_id", "url", "html").mapInPandas(
        convert, "page_id long, url string, text string, status string"
    )


def first_group(c: Column, pattern: str, max_chars: int | None = None, flags: str = "(?iU)") -> Column:
    """First capture of the pattern, trimmed; null when it does not occur.

    The patterns capture one character or more, so an empty capture is no hit: the page is scanned once.
    """
    hit = F.nullif(F.regexp_extract(c, flags + pattern, 1), F.lit(""))
    return cut(strip(hit), max_chars)


def page_signals(html: Column, final_url: Column, max_chars: int | None = None) -> dict[str, Column]:
    """Wall flags and the first field set of a fetched page."""
    out = {
        "auth_wall": html.rlike("(?i)" + AUTH_WALL),
        "captcha": html.rlike("(?i)" + CAPTCHA),
        "login_redirect": F.contains(text(final_url), F.lit("/login")) | F.contains(text(final_url), F.lit("authwall")),
    }
    for name, pattern in PAGE_FIELDS.items():
        out[name] = first_group(html, pattern, max_chars)
    return out


def profile_fields(html: Column, max_chars: int | None = None) -> dict[str, Column]:
    """The second field set, read from a page seen while signed in."""
    out = {name: first_group(html, p, max_chars) for name, p in PROFILE_FIELDS.items()}
    out["type"] = first_group(html, PROFILE_TYPE, max_chars, flags="(?U)")
    return out


def outbound_links(html: Column, limit: int | None = None) -> Column:
    """Absolute links of a page in order, without repeats and denied hosts; all, or the first ``limit``."""
    links = F.regexp_extract_all(html, F.lit(r'<a\b[^>]*\bhref="(http[^"]*)"'), 1)

    def allowed(u: Column) -> Column:
        host = F.regexp_extract(u, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1)
        ok = F.lit(True)
        for bad in LINK_DENY:
            ok = ok & ~F.contains(host, F.lit(bad))
        return ok

    found = F.array_distinct(F.filter(links, allowed))
    return found if limit is None else F.slice(found, 1, limit)


def embedded_fields(html: Column) -> dict[str, Column]:
    """Fields of the data a company page embeds, and its headquarters address."""
    out = {name: first_group(html, p, flags="") for name, p in EMBEDDED_FIELDS.items()}
    for name in ("employee_count", "follower_count"):
        out[name] = out[name].try_cast("int")
    # Context of every headquarters flag: 700 characters before, 200 from its start.
    before = F.split(html, HQ_FLAG)
    flags = F.regexp_extract_all(html, F.lit("(" + HQ_FLAG + ")"), 1)
    starts = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(flags), F.lit(1))),
        lambda i: F.aggregate(
            F.slice(before, 1, i), F.lit(0), lambda acc, s: acc + F.length(s)
        ) + F.aggregate(F.slice(flags, 1, i - 1), F.lit(0), lambda acc, s: acc + F.length(s)),
    )
    windows = F.transform(
        starts,
        lambda at: F.substr(html, F.greatest(at - 699, F.lit(1)), F.least(at, F.lit(700)) + 200),
    )
    useful = F.filter(
        windows,
        lambda w: w.rlike(ADDRESS_FIELDS["hq_city"]) | w.rlike(ADDRESS_FIELDS["hq_country"]) | w.rlike(ADDRESS_FIELDS["hq_line1"]),
    )
    context = F.when(F.size(flags) > 0, F.get(useful, F.lit(0)))
    for name, pattern in ADDRESS_FIELDS.items():
        out[name] = first_group(context, pattern, flags="")
    return out


def jsonld_nodes(html: Column) -> Column:
    """array<variant> of the organisation nodes in the JSON-LD blocks of a page."""
    blocks = F.regexp_extract_all(html, F.lit(JSONLD_SCRIPT), 1)
    as_list = F.transform(
        blocks, lambda b: F.when(strip(b).rlike(r"^\["), strip(b)).otherwise(F.concat(F.lit("["), strip(b), F.lit("]")))
    )
    return F.flatten(F.transform(as_list, lambda b: F.coalesce(F.from_json(b, "array<variant>"), F.array().cast("array<variant>"))))

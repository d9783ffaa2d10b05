"""Pages, requests and replies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tieproof.catalog.base import CFG, lit, query
from tieproof.catalog.base import s_strip
from tieproof.functions import pages as pg
from tieproof.functions import replies as rp
from tieproof.functions.text import once
from tieproof.operators import requests as rq

C = F.col


# Named references also count without their semicolon.
_UNESCAPE = (
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), "
    "'&quot;?', chr(34), 'g'), '&amp;?', '&', 'g')"
)


@query("tx_html_text", "", f"""
a AS (SELECT page_id, url, {s_strip(_UNESCAPE.format(x="regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))} AS title,
  regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS body FROM pages),
b AS (SELECT *, regexp_replace(body, '(?s)<!--.*?-->', chr(1), 'g') AS b1 FROM a),
c AS (SELECT *, list_transform(string_split(regexp_replace(b1, '<[^>]+>', chr(1), 'g'), chr(1)),
  lambda x: {s_strip(_UNESCAPE.format(x='x'))}) AS pieces FROM b),
d AS (SELECT *, regexp_replace(array_to_string(list_filter(pieces, lambda x: x <> ''), chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g') AS txt FROM c)
SELECT page_id, url, CASE WHEN length(txt) < 50 THEN '' WHEN title = '' THEN txt
   ELSE concat('[Page title: ', title, ']', chr(10), '[URL: ', url, ']', chr(10), chr(10), txt) END AS text,
  CASE WHEN length(txt) < 50 THEN 'empty' ELSE 'ok' END AS status FROM d""")
def tx_html_text(t):
    return pg.html_to_text(t.pages)


def s_chunks(size: int, overlap: int) -> str:
    step = size - overlap
    return f"""
c AS (SELECT doc_id, text, unnest(CASE WHEN length(text) <= {size} THEN [0] ELSE range(0, length(text), {step}) END) AS a FROM documents)
SELECT doc_id, CAST(a // {step} AS INTEGER) AS chunk_no, substr(text, CAST(a AS BIGINT) + 1, {size}) AS chunk FROM c"""


@query("tx_chunk", "", s_chunks(1000, 100))
def tx_chunk(t):
    return rq.chunk(t.documents.select("doc_id", "text"), "text", 1000, 100).select("doc_id", "chunk_no", "chunk")


@query("tx_request_trim", "", """
c AS (SELECT doc_id, text, length(text) + 300 <= 4000 AS fits FROM documents),
p AS (SELECT doc_id, text, fits, unnest(CASE WHEN fits THEN [0] ELSE range(0, length(text), 3200) END) AS a FROM c)
SELECT doc_id, CAST(a // 3200 AS INTEGER) AS part,
  CASE WHEN fits THEN text ELSE substr(text, CAST(a AS BIGINT) + 1, 3200) END AS request_text FROM p""")
def tx_request_trim(t):
    return rq.request_parts(t.documents.select("doc_id", "text"), "text", 300, 4000).select(
        "doc_id", "part", "request_text")


_MARK = lit(CFG.prompt_marker)
_AFTER = f"CASE WHEN contains(reply, {_MARK}) THEN string_split(reply, {_MARK})[-1] ELSE reply END"
_FENCED = "regexp_extract(reply, '(?s)```(?:json|JSON)?\\s*\\n?(.*?)\\n?\\s*```', 1)"


@query("tx_reply_slice", "replies", f"""
SELECT event_id, CASE WHEN contains(reply, '```') THEN {_FENCED}
  WHEN contains(reply, '{{') THEN regexp_extract({_AFTER}, '\\{{.*\\}}', 0) ELSE {s_strip(_AFTER)} END AS payload FROM replies""")
def tx_reply_slice(t):
    return t.replies.select("event_id", rp.reply_payload(C("reply"), CFG.prompt_marker).alias("payload"))


def has_k(b):
    return F.from_json(b, "k long")["k"].isNotNull()


@query("tx_reply_parse", "replies", f"""
SELECT event_id, CASE WHEN {s_strip('reply')} = '' THEN 'empty' WHEN NOT contains(reply, '{{') THEN 'schema_invalid'
    WHEN contains(reply, {_MARK}) THEN 'marker_sliced' WHEN contains(reply, '```') THEN 'fence_extracted'
    WHEN starts_with(reply, '{{') THEN 'parsed' ELSE 'payload_extracted' END AS outcome,
  TRY_CAST(regexp_extract(reply, '"k": (\\d+)', 1) AS BIGINT) AS k FROM replies""")
def tx_reply_parse(t):
    p = t.replies.withColumn("p", once(rp.typed_reply(C("reply"), CFG.prompt_marker, has_k)))
    return p.select("event_id", "p.outcome", F.from_json("p.payload", "k long")["k"].alias("k"))


@query("tx_reply_untyped", "replies", """
SELECT event_id, TRY_CAST(regexp_extract(reply, '"k": (\\d+)', 1) AS BIGINT) AS k FROM replies""")
def tx_reply_untyped(t):
    text = rp.recover_json(rp.cleaned_reply(C("reply"), CFG.prompt_marker), "object")
    value = F.try_variant_get(F.try_parse_json(text), "$.k", "long")
    return t.replies.select("event_id", value.alias("k"))


def s_broken(inner: str) -> str:
    return (f"concat('{{', chr(10), '\"name\": \"He said ', {inner}, event_type, {inner}, ' twice\",', chr(10), "
            "'\"n\": ', CAST(event_id AS VARCHAR), chr(10), '}')")


@query("tx_quote_repair", "", f"SELECT event_id, {s_broken('concat(chr(92), chr(34))')} AS repaired FROM events")
def tx_quote_repair(t):
    broken = F.concat(
        F.lit('{\n"name": "He said "'), C("event_type"), F.lit('" twice",\n"n": '), C("event_id").cast("string"), F.lit("\n}"))
    return t.events.select("event_id", rp.repair_quotes(broken).alias("repaired"))


_ECHO = "CASE WHEN doc_id % 2 = 0 THEN concat('Sure. ', text, ' done') WHEN doc_id % 4 = 1 THEN substr(text, 1, 150) ELSE 'ok' END"


@query("tx_echo", "", f"""
SELECT doc_id, length({_ECHO}) >= 20 AND {s_strip("right(text, 200)")} <> '' AND contains({_ECHO}, {s_strip("right(text, 200)")}) AS echo
FROM documents""")
def tx_echo(t):
    reply = (
        F.when(C("doc_id") % 2 == 0, F.concat(F.lit("Sure. "), "text", F.lit(" done")))
        .when(C("doc_id") % 4 == 1, F.substring("text", 1, 150)).otherwise("ok")
    )
    return t.documents.select("doc_id", rp.is_echo(reply, C("text")).alias("echo"))


_CODES = "concat('0:F 1 : E ', CAST(event_id % 4 AS VARCHAR), ':', substr('FEXIDANU', CAST(1 + event_id % 8 AS BIGINT), 1), ' 2:Z 3:NN')"
_CODE_CASE = "CASE c " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rp.CODES.items()) + " END"


@query("tx_code_tokens", "", f"""
r AS (SELECT event_id, {_CODES} AS reply FROM events),
x AS (SELECT event_id, unnest(regexp_extract_all(reply, '(\\d+)\\s*:\\s*([FEXIDANU])\\b', 1)) AS i,
   unnest(regexp_extract_all(reply, '(\\d+)\\s*:\\s*([FEXIDANU])\\b', 2)) AS c,
   generate_subscripts(regexp_extract_all(reply, '(\\d+)\\s*:\\s*([FEXIDANU])\\b', 1), 1) AS o FROM r),
l AS (SELECT event_id, CAST(i AS INTEGER) AS idx, arg_max({_CODE_CASE}, o) AS verdict FROM x GROUP BY ALL),
a AS (SELECT event_id, unnest([0, 1, 2, 3]) AS idx FROM events)
SELECT a.event_id, a.idx, coalesce(verdict, 'UNCLEAR') AS verdict FROM a LEFT JOIN l ON l.event_id = a.event_id AND l.idx = a.idx""")
def tx_code_tokens(t):
    reply = F.concat(
        F.lit("0:F 1 : E "), (C("event_id") % 4).cast("string"), F.lit(":"),
        F.substr(F.lit("FEXIDANU"), (1 + C("event_id") % 8).cast("int"), F.lit(1)), F.lit(" 2:Z 3:NN"))
    return rq.batch_verdicts(t.events.select("event_id", reply.alias("reply")), "event_id", "reply", F.lit(4))


@query("tx_one_token", "", """
SELECT event_id, CASE WHEN contains(substr(upper(concat(event_type, ' founder or not')), 1, 20), 'FOUNDER')
  THEN 'FOUNDER' ELSE 'NOT' END AS verdict FROM events""")
def tx_one_token(t):
    reply = F.concat("event_type", F.lit(" founder or not"))
    return t.events.select("event_id", rp.one_token_verdict(reply).alias("verdict"))


_DECISION = """concat('{"decisions":[{"company_name":"', company_name, '","verdict":"',
  CASE rec_seq % 3 WHEN 0 THEN 'Remove' WHEN 1 THEN 'keep' ELSE 'remove' END, '","reason":"r', CAST(rec_seq % 7 AS STRING),
  '"},{"company_name":"', CASE WHEN rec_seq % 2 = 0 THEN '' ELSE headquarters END, '","verdict":"remove"}]}')"""


@query("tx_decisions", "raw_records", f"""
d AS (SELECT rec_seq, {_DECISION} AS reply FROM raw_records),
x AS (SELECT rec_seq, unnest(CAST(json_extract(reply, '$.decisions[*]') AS JSON[])) AS j FROM d)
SELECT rec_seq, json_extract_string(j, '$.company_name') AS company_name, json_extract_string(j, '$.reason') AS reason FROM x
WHERE lower(json_extract_string(j, '$.verdict')) = 'remove' AND json_extract_string(j, '$.company_name') <> ''""")
def tx_decisions(t):
    return rq.names_to_remove(t.raw_records.select("rec_seq", F.expr(_DECISION).alias("reply")), "reply").drop("reply")


@query("tx_batch_requests", "", """
n AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents),
l AS (SELECT pos, CAST(floor(pos / 20) AS BIGINT) AS batch_no, to_json({idx: pos % 20, company: concat('Firm ', doc_id), person: source,
  role: lang, evidence: text, source: concat(source, '.example.org')}) AS line FROM n)
SELECT batch_no, count(*) AS n_rows, string_agg(line, chr(10) ORDER BY pos) AS request FROM l GROUP BY batch_no""")
def tx_batch_requests(t):
    return rq.batch_requests(t.documents, "doc_id", {
        "company": F.concat(F.lit("Firm "), C("doc_id").cast("string")), "person": C("source"), "role": C("lang"),
        "evidence": C("text"), "source": F.concat("source", F.lit(".example.org")),
    })


_ASK = (
    [f"CASE WHEN status = 'acquired' THEN '{f}' END" for f in rq.ACQUIRED_FIELDS]
    + [f"CASE WHEN funding_total_usd > 0 THEN '{f}' END" for f in rq.FUNDED_FIELDS]
    + ["CASE WHEN contains(founder, ' and ') THEN 'cofounder_schools' END"]
    + [f"'{f}'" for f in rq.ALWAYS_FIELDS]
)


@query("tx_conditional_fields", "raw_records", f"""
SELECT rec_seq, array_to_string(list_filter([{', '.join(_ASK)}], lambda x: x IS NOT NULL), ', ') AS fields FROM raw_records""")
def tx_conditional_fields(t):
    from tieproof.functions.names import split_people

    asked = rq.fields_to_ask(C("status"), C("funding_total_usd"), F.size(split_people(C("founder"))))
    return t.raw_records.select("rec_seq", F.array_join(asked, ", ").alias("fields"))


_LD = "regexp_extract(html, '(?s)<script[^>]*type=\"application/ld\\+json\"[^>]*>(.*?)</script>', 1)"
_NODE = f"CASE WHEN starts_with({_LD}, '[') THEN json_extract({_LD}, '$[0]') ELSE CAST({_LD} AS JSON) END"


@query("tx_jsonld", "org_pages", f"""
n AS (SELECT page_id, {_NODE} AS j FROM org_pages)
SELECT page_id, json_extract_string(j, '$.name') AS name, json_extract_string(j, '$.foundingDate') AS founding_date,
  CAST(json_extract_string(j, '$.numberOfEmployees.minValue') AS BIGINT) AS employees_min,
  CAST(json_extract_string(j, '$.numberOfEmployees.maxValue') AS BIGINT) AS employees_max,
  json_extract_string(j, '$.address.addressLocality') AS hq_locality, json_extract_string(j, '$.address.addressCountry') AS hq_country
FROM n WHERE json_extract_string(j, '$."@type"') = 'Organization'""")
def tx_jsonld(t):
    from tieproof.plans.pages import organisations

    return organisations(t.org_pages.select("page_id", "html")).select(
        "page_id", "name", "founding_date", "employees_min", "employees_max", "hq_locality", "hq_country")


_HQ = "contains(html, '\"headquarter\":true')"


@query("tx_embedded_fields", "org_pages", f"""
SELECT page_id, CAST(regexp_extract(html, '"employeeCount":(\\d+)', 1) AS INTEGER) AS employee_count,
  CAST(regexp_extract(html, '"followerCount" : (\\d+)', 1) AS INTEGER) AS follower_count,
  regexp_extract(html, '"staffCountRange":"([A-Z0-9_]+)"', 1) AS staff_count_range,
  regexp_extract(html, '"foundedOn":.*?"year":(\\d{{4}})', 1) AS founded_year,
  regexp_extract(html, '"tagline":"([^"]+)"', 1) AS tagline,
  regexp_extract(html, '"name":"([^"]+)","tagline"', 1) AS name,
  regexp_extract(html, '"companyPageUrl":"([^"]+)"', 1) AS website, CAST(NULL AS VARCHAR) AS company_url,
  regexp_extract(html, '"specialities":\\[([^\\]]+)\\]', 1) AS specialities,
  CASE WHEN {_HQ} THEN regexp_extract(html, '"city":"([^"]+)"', 1) END AS hq_city, CAST(NULL AS VARCHAR) AS hq_region,
  CASE WHEN {_HQ} THEN 'XX' END AS hq_country,
  CASE WHEN {_HQ} THEN regexp_extract(html, '"postalCode":"([^"]+)"', 1) END AS hq_postal,
  CASE WHEN {_HQ} THEN regexp_extract(html, '"line1":"([^"]+)"', 1) END AS hq_line1 FROM org_pages""")
def tx_embedded_fields(t):
    return t.org_pages.select("page_id", *[c.alias(n) for n, c in pg.embedded_fields(C("html")).items()])



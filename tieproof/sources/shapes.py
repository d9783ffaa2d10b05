"""The driver tables presented in the shapes the jobs read.

Each shape is one portable SELECT, run by Spark over DataFrames and by DuckDB
as a CTE, so that both sides of a check start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

SHAPES: dict[str, str] = {}

SHAPES["raw_records"] = """
SELECT c_custkey AS rec_seq,
       CASE c_custkey % 6
         WHEN 0 THEN concat('Firm ', k)
         WHEN 1 THEN concat('Firm ', k, ', Inc.')
         WHEN 2 THEN concat('FIRM ', k, ' LLC')
         WHEN 3 THEN concat('The Firm ', k)
         WHEN 4 THEN concat('Firm ', k, ' (formerly Other)')
         ELSE concat('Firm ', k, ' Ventures') END AS company_name,
       CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'Unknown'
         WHEN 2 THEN concat('Ann Lee', ' and ', 'Bo Park')
         WHEN 3 THEN 'Cy Diaz' ELSE 'madonna' END AS founder,
       CASE c_custkey % 4 WHEN 0 THEN 'founded the company, class of 2009'
         WHEN 1 THEN 'joined in 2015 as a manager'
         WHEN 2 THEN 'short' ELSE '' END AS evidence,
       CASE c_custkey % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'provisional' ELSE 'weak' END AS validation_tier,
       CASE c_custkey % 4 WHEN 0 THEN 'active' WHEN 1 THEN 'acquired' WHEN 2 THEN 'ipo' ELSE 'unknown' END AS status,
       CASE WHEN c_custkey % 7 = 0 THEN NULL
            ELSE CAST(floor(abs(c_acctbal)) AS BIGINT) * 1000 END AS funding_total_usd,
       CASE c_custkey % 5 WHEN 0 THEN '$12M' WHEN 1 THEN '12.5 million' WHEN 2 THEN '1,250,000'
         WHEN 3 THEN 'n/a' ELSE 'lots' END AS funding_text,
       CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 1950 + c_custkey % 75 END AS founded_year,
       CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE c_custkey % 900 END AS employee_count,
       c_mktsegment AS industry,
       n_name AS headquarters,
       CASE c_custkey % 3 WHEN 0 THEN 'https://www.crunchbase.com/x'
         WHEN 1 THEN 'https://list.example.org/y' ELSE '' END AS proof_url
FROM (SELECT *, CAST(CAST(floor(c_custkey / 6) AS BIGINT) AS STRING) AS k FROM {customer}) c
JOIN {nation} ON c_nationkey = n_nationkey
"""

# Records with the remaining fields of the flat layout.
SHAPES["legacy_records"] = """
SELECT r.*,
       CASE rec_seq % 4 WHEN 0 THEN 'Alumni' WHEN 1 THEN 'Licensed Tech' WHEN 2 THEN '' ELSE 'Faculty' END
         AS affiliation_type,
       CASE rec_seq % 3 WHEN 0 THEN '' WHEN 1 THEN concat('Makes ', lower(industry)) ELSE 'n/a' END AS description,
       CASE rec_seq % 7 WHEN 0 THEN 'Ann Lee, Bo Park' WHEN 1 THEN 'various' WHEN 2 THEN 'Cy Diaz'
         WHEN 3 THEN 'Unknown' ELSE '' END AS founders,
       CASE WHEN rec_seq % 10 = 0 THEN ''
            ELSE concat('https://src', CAST(rec_seq % 11 AS STRING), '.example.org/p') END AS source_url,
       CAST(1 + rec_seq % 5 AS INT) AS source_credibility,
       CASE rec_seq % 13 WHEN 0 THEN 'true' WHEN 1 THEN 'No' WHEN 2 THEN 'maybe' ELSE '' END AS is_public,
       CASE rec_seq % 8 WHEN 0 THEN 'Series A' WHEN 1 THEN 'seed' WHEN 2 THEN 'preseed'
         WHEN 3 THEN 'B' WHEN 4 THEN 'late' ELSE '' END AS funding_stage,
       CASE rec_seq % 6 WHEN 0 THEN '2015' WHEN 1 THEN '1750' WHEN 2 THEN 'unknown'
         WHEN 3 THEN '12.0' ELSE '' END AS exit_year,
       CASE rec_seq % 9 WHEN 0 THEN '51-200' WHEN 1 THEN '25+' WHEN 2 THEN 'n/a' WHEN 3 THEN 'few'
         WHEN 4 THEN '1,200' ELSE '' END AS employees_text,
       CASE WHEN rec_seq % 4 = 1 THEN concat('Buyer ', CAST(rec_seq % 17 AS STRING)) ELSE '' END AS acquirer,
       CASE WHEN rec_seq % 4 = 1 THEN rec_seq % 500 * 1000000 ELSE NULL END AS acquisition_amount_usd,
       CASE WHEN rec_seq % 12 = 0 THEN 'Active' WHEN rec_seq % 12 = 1 THEN 'shut down'
            WHEN rec_seq % 12 = 2 THEN 'Listed' ELSE status END AS status_text,
       rec_seq % 5 = 0 AS verified
FROM {raw_records} r
"""

SHAPES["affiliations"] = """
SELECT concat('P', CAST(l_suppkey AS STRING)) AS person,
       concat('C', CAST(l_orderkey AS STRING)) AS company,
       l_returnflag AS role, n_name AS school, l_linenumber AS pos
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey
"""

SHAPES["call_log"] = """
SELECT event_id, ts, user_id AS session_id,
       CAST(floor(value * 10) AS BIGINT) AS latency_ms,
       CAST(extract(day FROM ts) AS INT) AS round,
       CASE event_type WHEN 'click' THEN 'parsed' WHEN 'view' THEN 'parsed'
         WHEN 'purchase' THEN 'schema_invalid' WHEN 'signup' THEN 'empty'
         ELSE 'prompt_echoed' END AS outcome
FROM {events}
"""

SHAPES["fetch_log"] = """
SELECT event_id, ts, user_id AS session_id,
       CASE event_id % 3 WHEN 0 THEN 'cache' WHEN 1 THEN 'http' ELSE 'browser' END AS path,
       CASE event_type WHEN 'error' THEN 'timeout' WHEN 'signup' THEN 'empty' ELSE 'ok' END AS outcome,
       CASE event_type WHEN 'error' THEN 503 WHEN 'signup' THEN 429 WHEN 'purchase' THEN 404 ELSE 200 END AS http_status,
       CAST(floor(value * 10) AS BIGINT) AS latency_ms,
       CAST(extract(day FROM ts) AS INT) AS round
FROM {events}
"""

SHAPES["verdicts"] = """
SELECT doc_id,
       CASE WHEN quality = 1 AND toxic = 0 THEN 'FOUNDER'
            WHEN quality = 1 THEN 'EXECUTIVE'
            WHEN toxic = 0 THEN 'UNCLEAR' ELSE 'NONCOMPANY' END AS verdict
FROM {labels}
"""

# The log behind the verdicts: a third of the documents were judged once before.
SHAPES["verdict_lines"] = """
SELECT doc_id, doc_id * 2 + 1 AS seq, verdict FROM {verdicts}
UNION ALL
SELECT doc_id, doc_id * 2, CASE verdict WHEN 'UNCLEAR' THEN 'FOUNDER' ELSE 'UNCLEAR' END FROM {verdicts} WHERE doc_id % 3 = 0
"""

SHAPES["claims"] = """
SELECT d.doc_id, d.lang, d.text AS source_text,
       CASE WHEN d.doc_id % 3 = 0 THEN translate(substr(d.text, 2, 40), 'aeinrst', 'AEINRST')
            WHEN d.doc_id % 3 = 1 THEN concat('  ', substr(d.text, 5, 30), ' ')
            ELSE substr(b.text, 1, 60) END AS span
FROM {documents} d JOIN {benchmark} b ON b.item_id = d.doc_id % 40
"""

SHAPES["replies"] = """
SELECT event_id,
       CASE event_id % 6 WHEN 0 THEN props
         WHEN 1 THEN concat('Here it is:', chr(10), '```json', chr(10), props, chr(10), '```')
         WHEN 2 THEN concat('JSON', props)
         WHEN 3 THEN concat('echo ===END_PROMPT===REPLY_BELOW===', props)
         WHEN 4 THEN 'no json here' ELSE '' END AS reply
FROM {events}
"""

SHAPES["procs"] = """
SELECT p_partkey AS pid,
       CASE WHEN p_partkey % 50 = 0 THEN p_partkey + 1000000
            ELSE CAST(floor(p_partkey / 2) AS BIGINT) END AS ppid,
       CASE WHEN p_partkey % 50 = 0 OR p_partkey > 20 THEN 'chrome.exe' ELSE 'python.exe' END AS name
FROM {part}
"""

SHAPES["log_lines"] = """
SELECT event_id AS seq, CAST(floor(event_id / 6) AS BIGINT) AS run_id, ts,
       CASE event_type WHEN 'click' THEN concat('DB total: ', CAST(event_id AS STRING))
         WHEN 'view' THEN concat('Still waiting... elapsed=', CAST(event_id % 700 AS STRING), 's')
         WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'Traceback (most recent call last) in run' ELSE 'CAPTCHA detected' END
         WHEN 'purchase' THEN 'CAPTCHA cleared'
         ELSE 'SESSION ENDED' END AS line
FROM {events}
"""

# Free-text values of the typed fields, one row per part.
SHAPES["loose_values"] = """
SELECT p_partkey,
       CASE p_partkey % 7 WHEN 0 THEN concat(CAST(p_size AS STRING), '-', CAST(p_size * 4 + 1 AS STRING))
         WHEN 1 THEN concat(CAST(p_size AS STRING), '+') WHEN 2 THEN 'n/a' WHEN 3 THEN '5,000-10,000'
         WHEN 4 THEN concat(' ', CAST(p_partkey AS STRING)) WHEN 5 THEN 'few' ELSE '' END AS count_text,
       CASE p_partkey % 7 WHEN 0 THEN 'true' WHEN 1 THEN ' No' WHEN 2 THEN 'Y' WHEN 3 THEN 'n'
         WHEN 4 THEN 'maybe' WHEN 5 THEN 'FALSE' ELSE '' END AS bool_text,
       CASE p_partkey % 9 WHEN 0 THEN 'Series A' WHEN 1 THEN ' seed' WHEN 2 THEN 'preseed' WHEN 3 THEN 'b'
         WHEN 4 THEN 'Pre Seed' WHEN 5 THEN 'series_c' WHEN 6 THEN 'late' WHEN 7 THEN 'IPO' ELSE '' END AS stage_text,
       CASE p_partkey % 4 WHEN 0 THEN concat(p_type, ', ', p_brand, ' ; ')
         WHEN 1 THEN concat(p_type, '/', p_name) WHEN 2 THEN '' ELSE p_type END AS tag_text,
       CASE p_partkey % 6 WHEN 0 THEN '$1.2B' WHEN 1 THEN concat('~', CAST(p_size AS STRING), ' million')
         WHEN 2 THEN '7 trillion' WHEN 3 THEN 'over 300k' WHEN 4 THEN '5million' ELSE CAST(p_partkey AS STRING) END
         AS money_text,
       CASE p_partkey % 6 WHEN 0 THEN '1999' WHEN 1 THEN '1750' WHEN 2 THEN ' 2031 ' WHEN 3 THEN '12.0'
         WHEN 4 THEN 'N/A' ELSE '' END AS year_text
FROM {part}
"""

SHAPES["titles"] = """
SELECT p_partkey, p_type AS category,
       CASE p_partkey % 5 WHEN 0 THEN concat('List of ', p_name)
         WHEN 1 THEN concat('Firm ', CAST(p_partkey AS STRING))
         WHEN 2 THEN concat(p_name, ' (disambiguation)')
         WHEN 3 THEN concat('Category:', p_name)
         ELSE concat('The Firm ', CAST(p_partkey AS STRING), ' Corp.') END AS title
FROM {part}
"""

SHAPES["articles"] = """
SELECT c_custkey AS article_id,
       CASE c_custkey % 5 WHEN 0 THEN concat('Firm ', k) WHEN 1 THEN concat('Firm ', k, ' (company)')
         WHEN 2 THEN concat('Firm ', k, ', Inc.') WHEN 3 THEN concat('The Firm ', k)
         ELSE concat('Firm ', k, ' Ventures') END AS title,
       CASE WHEN c_custkey % 7 = 0 THEN 'disambiguation' ELSE 'standard' END AS type,
       CASE c_custkey % 3 WHEN 0 THEN 'American software company' WHEN 1 THEN 'A place' ELSE '' END AS description,
       CASE c_custkey % 6
         WHEN 0 THEN concat('It was founded in ', CAST(1980 + c_custkey % 40 AS STRING), ' and is based in ', n_name, '.')
         WHEN 1 THEN concat('It was acquired by Buyer ', k, ' in 2010.')
         WHEN 2 THEN 'It went public in 1999; headquartered in Oslo, it ceased operations.'
         WHEN 3 THEN concat('The village of ', n_name, ' was shut down in 2001.')
         WHEN 4 THEN 'Established 1755. Based in the old town; nothing else is known.'
         ELSE '' END AS extract
FROM (SELECT *, CAST(CAST(floor(c_custkey / 9) AS BIGINT) AS STRING) AS k FROM {customer}) c
JOIN {nation} ON c_nationkey = n_nationkey
"""

SHAPES["visits"] = """
SELECT e.event_id, e.ts, CAST(extract(day FROM e.ts) AS INT) AS round, p.url
FROM {events} e JOIN {pages} p ON p.page_id = e.user_id
"""

# Pages with embedded organisation data, one per supplier.
SHAPES["org_pages"] = """
SELECT s_suppkey AS page_id,
       concat('https://org.example.net/', CAST(s_suppkey AS STRING)) AS url,
       concat('<html><head><script type="application/ld+json">',
         CASE WHEN s_suppkey % 3 = 0 THEN '[' ELSE '' END,
         '{"@type":"', CASE WHEN s_suppkey % 4 = 3 THEN 'Place' ELSE 'Organization' END,
         '","name":"', s_name, '","foundingDate":"', CAST(1950 + s_suppkey % 70 AS STRING),
         '","numberOfEmployees":{"minValue":', CAST(s_suppkey % 50 AS STRING), ',"maxValue":',
         CAST(s_suppkey % 50 + 100 AS STRING), '},"address":{"addressLocality":"', n_name,
         '","addressCountry":"XX"}}',
         CASE WHEN s_suppkey % 3 = 0 THEN ']' ELSE '' END,
         '</script></head><body><code>{"employeeCount":', CAST(s_suppkey * 3 AS STRING),
         ',"followerCount" : ', CAST(s_suppkey * 7 AS STRING),
         ',"staffCountRange":"SIZE_', CAST(s_suppkey % 5 AS STRING),
         '","foundedOn":{"month":1,"year":', CAST(1950 + s_suppkey % 70 AS STRING),
         '},"name":"', s_name, '","tagline":"We make it ', n_name,
         '","companyPageUrl":"https://', lower(n_name), '.example.com/","url":"https://www.linkedin.com/x"',
         ',"specialities":["a","b ', n_name, '"]',
         CASE WHEN s_suppkey % 2 = 0
              THEN concat(',"address":{"city":"', n_name, '","country":"XX","line1":"', CAST(s_suppkey AS STRING),
                          ' Main St","postalCode":"P', CAST(s_suppkey AS STRING), '"},"headquarter":true') ELSE '' END,
         '}</code></body></html>') AS html
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
"""


# Verdicts by company name, the second look at the unclear ones, and outside lookups.
SHAPES["verdict_log"] = """
SELECT r.rec_seq AS seq, r.company_name, v.verdict
FROM {raw_records} r JOIN {verdicts} v ON v.doc_id = r.rec_seq
"""

SHAPES["recovery_log"] = """
SELECT seq, company_name, CASE WHEN seq % 2 = 0 THEN 'FOUNDER' ELSE 'NOT' END AS verdict
FROM {verdict_log} WHERE verdict = 'UNCLEAR'
"""

SHAPES["bindings"] = """
SELECT rec_seq, company_name AS company,
       CASE WHEN rec_seq % 2 = 0 THEN 'Carla Diaz' ELSE 'Bo Park' END AS founder
FROM {raw_records} WHERE status IN ('acquired', 'ipo')
"""

SHAPES["registry"] = """
SELECT s_suppkey AS reg_seq, lower(concat('Firm ', CAST(CAST(floor(s_suppkey / 2) AS BIGINT) AS STRING))) AS lookup_name,
       concat(s_name, ' / ', n_name, ' / ', CAST(s_suppkey AS STRING)) AS detail
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
"""

# Replies that carry one record each, several per page.
# Fetched company pages: walls on some of them, every field of both sets on most.
SHAPES["profile_pages"] = """
SELECT page_id, concat('https://pages.example.org/', CASE WHEN page_id % 5 = 0 THEN 'login' WHEN page_id % 7 = 0 THEN 'authwall' ELSE 'c' END) AS url,
  concat('<html><title> Firm ', id, ' | Pages</title><meta property="og:description" content="About firm ', id, '">',
    CASE WHEN page_id % 3 = 0 THEN '<p>Sign in to view the page</p>' ELSE '' END, CASE WHEN page_id % 4 = 1 THEN '<p>Are you a robot</p>' ELSE '' END,
    CASE WHEN page_id % 6 = 0 THEN '' ELSE concat('<p>Founded: ', CAST(1950 + page_id % 70 AS STRING), '</p><p>', CAST(100 + page_id % 900 AS STRING), ' employees</p>') END,
    '<p>Headquarters: Town ', id, '</p><p>Specialties: tools, parts ', id, '</p><p>Industry: Trade ', id, '</p><p>Company size: 11-', id,
    ' people</p><p>Type: Held by ', id, '</p><a href="https://firm', id, '.example.org/"><span class="l">Website</span></a></html>') AS html
FROM (SELECT page_id, CAST(page_id AS STRING) AS id FROM {pages}) AS a
"""

SHAPES["page_replies"] = """
SELECT doc_id, page_url, source_text, concat('Found:', chr(10), '```json', chr(10),
         CASE doc_id % 3 WHEN 0 THEN concat('{"company_name":"Firm ', firm, ', Inc.","person":"P', id, '","span":"', span, '"}')
           WHEN 1 THEN concat('[', nested, ',', other, ']') ELSE concat('{"records":[', other, ',', nested, ']}') END,
         chr(10), '```') AS reply
FROM (SELECT *, concat('{"company_name":"Firm ', firm, ', Inc.","people":[{"name":"Q', id, '","evidence_span":"not on the page, no"},',
                       '{"name":"P', id, '","evidence_span":"', span, '"}]}') AS nested,
             '{"company_name":"Other","people":[{"name":"X","evidence_span":"zzz not there"}]}' AS other
      FROM (SELECT c.doc_id, concat('https://', d.source, '.example.org/') AS page_url, c.source_text,
                   CAST(c.doc_id % 7 AS STRING) AS firm, CAST(c.doc_id AS STRING) AS id,
                   translate(c.span, concat(chr(34), chr(92), chr(10)), '   ') AS span
            FROM {claims} c JOIN {documents} d ON d.doc_id = c.doc_id) AS a) AS b
"""

SHAPES["second_replies"] = """
SELECT doc_id, source_text,
       concat('{"company_name":"Firm","industry":"I', CAST(doc_id % 5 AS STRING), '","industry_evidence_span":"',
              translate(span, concat(chr(34), chr(92), chr(10)), '   '), '","headquarters":"H', CAST(doc_id % 3 AS STRING),
              '","headquarters_evidence_span":"","founded_year":', CASE WHEN doc_id % 4 = 0 THEN 'null' ELSE '1999' END,
              ',"website_url":""}') AS reply
FROM {claims}
"""

# What a targeted search found for a record.
SHAPES["found_facts"] = """
SELECT rec_seq, CASE rec_seq % 4 WHEN 0 THEN 'Dana Fox, Eli Ray' WHEN 1 THEN 'unknown' WHEN 2 THEN ' Fay Low ' ELSE '' END AS found_founders,
       CASE rec_seq % 3 WHEN 0 THEN '' WHEN 1 THEN 'https://found.example.net/a' ELSE 'n/a' END AS found_url,
       concat('https://page', CAST(rec_seq % 4 AS STRING), '.example.net/') AS page_url,
       concat('Page about ', company_name) AS page_text
FROM {legacy_records} WHERE status <> 'ipo'
"""

# Pages with outbound links: repeats, a denied host, and more than ten of them on some.
SHAPES["link_pages"] = (
    "SELECT page_id, url, concat('<a href=\"', url, '\">1</a><a class=\"x\" href=\"https://www.google.com/s\">g</a>', "
    "'<a href=\"', url, '\">again</a><a href=\"/local\">l</a>', CASE WHEN page_id % 3 = 0 THEN concat("
    + ", ".join(f"'<a href=\"', url, '&n={i}\">{i}</a>'" for i in range(12))
    + ") ELSE '' END, html) AS html FROM {pages}"
)


def _escaped(sql: str) -> str:
    """Braces that are JSON text, not placeholders, doubled for string formatting."""
    return re.sub(r"\{(\w+)\}|[{}]", lambda m: m[0] if m[1] else m[0] * 2, sql)


SHAPES.update({name: _escaped(sql) for name, sql in SHAPES.items()})


def depends_on(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


class Tables:
    """Tables and shapes of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            if name in SHAPES:
                parts = {d: getattr(self, d) for d in depends_on(SHAPES[name])}
                # The alias hides the table aliases used inside the shape.
                self._frames[name] = self.spark.sql(SHAPES[name], **parts).alias(name)
            elif name in TABLES:
                self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                raise AttributeError(name)
        return self._frames[name]


def with_shapes(names: str, body: str) -> str:
    """DuckDB text: the shapes as CTEs in front of ``body``.

    ``body`` starts with SELECT, or with further CTEs ("x AS (...) SELECT ...").
    """
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in SHAPES and name not in ordered:
            for d in depends_on(SHAPES[name]):
                visit(d)
            ordered.append(name)

    for n in names.split():
        visit(n)
    ctes = [f"{n} AS ({SHAPES[n].format(**{d: d for d in depends_on(SHAPES[n])})})" for n in ordered]
    body = body.strip()
    if body[:6].upper() == "SELECT":
        return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body
    recursive = body[:9].upper() == "RECURSIVE"
    body = body[9:].strip() if recursive else body
    return "WITH " + ("RECURSIVE " if recursive else "") + ",\n".join(ctes + [body])

"""Streams and stateful log analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from tieproof.catalog.base import CFG, query
from tieproof.catalog.jobs import S_STORE, UPSERT_OUT
from tieproof.catalog.aggregates import s_upsert
from tieproof.catalog.rules import s_validate
from tieproof.operators import graph, logs, process_tree, stats
from tieproof.operators.merge import last_per_key
from tieproof.session import scratch
from tieproof.sources.shapes import Tables
from tieproof.streaming import jobs, keyed, ladder, run

C = F.col


class Streamed(Tables):
    """The same shapes with one table read as a stream."""

    def __init__(self, t: Tables, *streamed: str):
        super().__init__(t.spark, t.folder)
        for name in streamed:
            schema = t.spark.read.parquet(f"{t.folder}/{name}.parquet").schema
            self._frames[name] = t.spark.readStream.schema(schema).parquet(f"{t.folder}/{name}*.parquet")


# The ladder replayed row by row: one recursion step per observation of a session.
S_LADDER = """RECURSIVE
obs AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id, kind) AS n,
    epoch_us(ts) / 1e6 AS now FROM (
  SELECT session_id, event_id, ts, round, 'call' AS kind, outcome FROM call_log
  UNION ALL SELECT session_id, event_id, ts, round, 'fetch', outcome FROM fetch_log)),
steps(session_id, n, event_id, kind, round, level, since, healthy, resets, calls, fetches) AS (
  SELECT DISTINCT session_id, 0::BIGINT, NULL::BIGINT, NULL::VARCHAR, NULL::INTEGER, 1, NULL::DOUBLE, NULL::DOUBLE, 0, '', '' FROM obs
  UNION ALL
  SELECT session_id, n, event_id, kind, round, level,
    CASE WHEN level = 1 THEN NULL ELSE coalesce(since, now) END,
    CASE WHEN level = 1 THEN now ELSE healthy END,
    CASE WHEN level > 1 AND since IS NULL AND now - healthy > 900 THEN 0 ELSE resets END, calls, fetches
  FROM (SELECT *, CASE
      WHEN kind = 'call' AND letter = 'e' AND right(calls, 5) = 'eeeee' AND t_level < 3 THEN 3
      WHEN kind = 'call' AND length(calls) = 20 AND length(replace(calls, 'p', '')) > 6 THEN greatest(t_level, 2)
      WHEN kind = 'fetch' AND length(fetches) = 20 AND length(replace(fetches, 'x', '')) < 10 THEN greatest(t_level, 4)
      ELSE t_level END AS level
    FROM (SELECT session_id, n, event_id, kind, round, now, letter,
        CASE WHEN stop THEN 5 WHEN reset THEN 1 ELSE level END AS t_level,
        CASE WHEN reset THEN NULL ELSE since END AS since, CASE WHEN reset THEN now ELSE healthy END AS healthy,
        resets + CAST(reset AS INTEGER) AS resets,
        right(concat(CASE WHEN reset THEN '' ELSE calls END, CASE WHEN kind = 'call' THEN letter ELSE '' END), 20) AS calls,
        right(concat(CASE WHEN reset THEN '' ELSE fetches END, CASE WHEN kind = 'fetch' THEN letter ELSE '' END), 20) AS fetches
      FROM (SELECT *, due AND (now - since > 3600 OR resets >= 3) AS stop,
          due AND NOT (now - since > 3600 OR resets >= 3) AND now - since > 900 AS reset
        FROM (SELECT o.session_id, o.n, o.event_id, o.kind, o.round, o.now, s.level, s.since,
            coalesce(s.healthy, o.now) AS healthy, s.resets, s.calls, s.fetches,
            coalesce(s.round <> o.round, false) AND s.level > 1 AND s.since IS NOT NULL AS due,
            CASE WHEN o.kind = 'fetch' THEN CASE WHEN o.outcome = 'ok' THEN 'o' ELSE 'x' END
                 WHEN o.outcome = 'parsed' THEN 'p' WHEN o.outcome = 'prompt_echoed' THEN 'e' ELSE 'x' END AS letter
          FROM steps s JOIN obs o ON o.session_id = s.session_id AND o.n = s.n + 1)))))
SELECT session_id, event_id, kind, level, resets FROM steps WHERE n > 0"""


@query("st_ladder", "call_log fetch_log", S_LADDER)
def st_ladder(t):
    s = Streamed(t, "events")
    return ladder.levels(run.drain_to_log(ladder.observations(s.call_log, s.fetch_log)))


@query("st_visited", "visits", "SELECT DISTINCT url, CAST(floor(round / 20) AS INTEGER) AS epoch FROM visits")
def st_visited(t):
    return jobs.visited(run.drain_to_log(Streamed(t, "events").visits, jobs.visits_of))


@query("st_round_metrics", "call_log fetch_log", "c AS (SELECT CAST(ts AS DATE) AS day, count(*) AS calls, " + ", ".join(
    f"count(*) FILTER (outcome = '{o}') AS {o}" for o in stats.CALL_OUTCOMES)
    + ", CAST(floor(sum(latency_ms) / count(*)) AS BIGINT) AS avg_latency_ms FROM call_log GROUP BY 1), "
    "f AS (SELECT CAST(ts AS DATE) AS day, count(*) AS fetches, count(*) FILTER (path = 'cache') AS path_cache, "
    "count(*) FILTER (path = 'http') AS path_http, count(*) FILTER (path = 'browser') AS path_browser, "
    "count(*) FILTER (outcome = 'ok') AS fetch_ok FROM fetch_log GROUP BY 1) "
    "SELECT *, round(fetch_ok / fetches, 3) AS fetch_ok_rate FROM c JOIN f USING (day)")
def st_round_metrics(t):
    s = Streamed(t, "events")
    return jobs.round_metrics(run.drain_to_log(s.call_log, jobs.call_sums), run.drain_to_log(s.fetch_log, jobs.fetch_sums))


@query("st_upsert", "legacy_records", S_STORE.replace("CASE WHEN verified THEN 0 ELSE 1000000000000 END", "0")
       + s_upsert("ord") + "," + s_validate("store", "n_sources")
       + f"SELECT {', '.join(UPSERT_OUT)}, n_sources, tier, issue_text FROM validated")
def st_upsert(t):
    sink = jobs.StoreSink(scratch(t.spark), CFG)
    run.drain_each_batch(Streamed(t, "customer").legacy_records, sink)
    return sink.result(t.spark).select(
        *UPSERT_OUT, "n_sources", C("validation_tier").alias("tier"),
        F.array_join("validation_issues", "; ").alias("issue_text"))


S_WATCH = """
x AS (SELECT *, TRY_CAST(regexp_extract(line, 'elapsed=(\\d+)s', 1) AS BIGINT) AS waited,
  TRY_CAST(regexp_extract(line, 'DB total:\\s*(\\d+)', 1) AS BIGINT) AS total FROM log_lines),
r AS (SELECT run_id, bool_or(line = 'SESSION ENDED') AS clean, bool_or(starts_with(line, 'Traceback')) AS trace, coalesce(max(waited), 0) AS longest_wait_s,
  coalesce(max(seq) FILTER (line = 'CAPTCHA detected'), -1) > coalesce(max(seq) FILTER (line = 'CAPTCHA cleared'), -1) AS wall_pending,
  arg_max(total, seq) FILTER (total IS NOT NULL) AS store_total, max(ts) AS last FROM x GROUP BY run_id)"""


@query("st_log_watch", "log_lines", S_WATCH + """
SELECT run_id, CASE WHEN clean THEN 'clean' WHEN trace THEN 'crash' ELSE 'unknown' END AS exit_kind, longest_wait_s, wall_pending, store_total,
  CASE WHEN epoch_us((SELECT max(ts) FROM log_lines)) - epoch_us(last) >= 900000000 THEN 'frozen' WHEN longest_wait_s >= 600 THEN 'hang'
       WHEN wall_pending THEN 'wall' ELSE 'healthy' END AS state FROM r""")
def st_log_watch(t):
    return logs.run_report(t.log_lines)


@query("st_log_watch_stream", "log_lines", S_WATCH + "SELECT run_id, longest_wait_s, wall_pending, store_total FROM r")
def st_log_watch_stream(t):
    return run.drain_updates(jobs.watch(Streamed(t, "events").log_lines), ["run_id"])


@query("st_process_tree", "procs", """RECURSIVE
c AS (SELECT * FROM procs WHERE name = 'chrome.exe'),
roots AS (SELECT pid FROM c WHERE NOT EXISTS (SELECT 1 FROM procs p WHERE p.pid = c.ppid)),
tree(pid, root) AS (SELECT pid, pid FROM roots UNION SELECT c.pid, tree.root FROM c JOIN tree ON c.ppid = tree.pid)
SELECT pid, root FROM tree""")
def st_process_tree(t):
    return process_tree.orphans(t.procs, CFG.watched_process)


@query("st_process_count", "procs", """RECURSIVE
tree(pid) AS (SELECT pid FROM procs WHERE pid = 3 UNION SELECT p.pid FROM procs p JOIN tree ON p.ppid = tree.pid)
SELECT count(*) AS n, count(*) >= 90 AS alarm FROM tree JOIN procs ON procs.pid = tree.pid WHERE name = 'chrome.exe' AND tree.pid <> 3""")
def st_process_count(t):
    below = process_tree.descendants(t.procs, 3, CFG.watched_process)
    return below.agg(F.count("*").alias("n")).withColumn("alarm", C("n") >= 90)


@query("st_candidates", "fetch_log", """
p AS (SELECT session_id, count(*) FILTER (outcome <> 'ok') AS attempts, arg_max(outcome, epoch_us(ts)) AS last_outcome, max(ts) AS last
      FROM fetch_log GROUP BY session_id)
SELECT session_id, attempts, last_outcome, CASE WHEN last_outcome = 'ok' THEN 'promoted' WHEN attempts > 5 THEN 'parked'
  WHEN epoch_us((SELECT max(ts) FROM fetch_log)) - epoch_us(last) < 3600000000 THEN 'cooling' ELSE 'eligible' END AS state
FROM p WHERE attempts > 0""")
def st_candidates(t):
    return logs.candidates(t.fetch_log)


_STATE = "CASE verdict WHEN 'FOUNDER' THEN 'verified' WHEN 'UNCLEAR' THEN 'needs_human' ELSE 'rejected' END"


@query("st_states", "verdicts", f"""
h AS (SELECT doc_id, 1 AS step, 'new' AS state FROM documents UNION ALL SELECT doc_id, 2, 'queued' FROM documents WHERE lang <> 'de'
  UNION ALL SELECT doc_id, 3, 'verifying' FROM verdicts UNION ALL SELECT doc_id, 4, {_STATE} FROM verdicts)
SELECT doc_id, arg_max(state, step) AS state, arg_max(state, step) = 'verified' AS published FROM h GROUP BY doc_id""")
def st_states(t):
    def step(df, n, state):
        return df.select("doc_id", F.lit(n).alias("step"), state.alias("state"))

    history = (
        step(t.documents, 1, F.lit("new"))
        .union(step(t.documents.where("lang <> 'de'"), 2, F.lit("queued")))
        .union(step(t.verdicts, 3, F.lit("verifying")))
        .union(step(t.verdicts, 4, F.expr(_STATE)))
    )
    return last_per_key(history, "doc_id", "step").select("doc_id", "state", (C("state") == "verified").alias("published"))


EXPAND_BUDGET = 40


def _s_hop(n: int) -> str:
    """One hop more: companies not met, people not seen, the first of them by links and name."""
    met = f"SELECT company FROM m{n - 1}" if n > 1 else "SELECT NULL WHERE false"
    return f"""
c{n} AS (SELECT DISTINCT company FROM m WHERE person IN (SELECT person FROM f{n - 1}) AND company NOT IN ({met})),
m{n} AS (SELECT company FROM c{n} UNION ALL {met}),
r{n} AS (SELECT person, {n} AS hop, row_number() OVER (ORDER BY count(*) DESC, person) AS rank, min(company) AS via FROM m
  WHERE company IN (SELECT company FROM c{n}) AND person NOT IN (SELECT person FROM s{n - 1}) GROUP BY person),
f{n} AS (SELECT * FROM r{n} WHERE rank <= {EXPAND_BUDGET}), s{n} AS (SELECT * FROM s{n - 1} UNION ALL SELECT * FROM f{n})"""


@query("st_expand", "affiliations", f"""
m AS (SELECT DISTINCT company, person FROM affiliations),
f0 AS (SELECT * FROM (SELECT person, 0 AS hop, row_number() OVER (ORDER BY person) AS rank, CAST(NULL AS VARCHAR) AS via
  FROM (SELECT DISTINCT person FROM affiliations WHERE school = 'NATION_1')) WHERE rank <= {EXPAND_BUDGET}),
s0 AS (SELECT * FROM f0),{_s_hop(1)},{_s_hop(2)},{_s_hop(3)}
SELECT person, hop, rank, via FROM s3""")
def st_expand(t):
    seeds = t.affiliations.where("school = 'NATION_1'").select("person")
    return graph.expand(t.affiliations, seeds, hops=3, budget=EXPAND_BUDGET)


@query("st_candidate_log", "fetch_log", """
x AS (SELECT *, sum(CAST(outcome <> 'ok' AS BIGINT)) OVER w AS attempts FROM fetch_log WINDOW w AS (PARTITION BY session_id ORDER BY ts, event_id)),
y AS (SELECT *, CASE WHEN outcome <> 'ok' THEN CASE WHEN attempts > 5 THEN 'parked' ELSE 'demoted' END
  WHEN attempts > 0 THEN 'promoted' ELSE 'new' END AS change FROM x)
SELECT session_id, us, event_id, change, CAST(attempts AS BIGINT) AS attempts FROM (
  SELECT *, epoch_us(ts) AS us, lag(change, 1, 'new') OVER (PARTITION BY session_id ORDER BY ts, event_id) AS was FROM y) WHERE change <> was""")
def st_candidate_log(t):
    return run.drain_to_table(keyed.candidate_log(Streamed(t, "events").fetch_log))


@query("st_state_log", "verdicts", f"""
a AS (SELECT doc_id, 1 AS step, 'new' AS state FROM documents UNION ALL SELECT doc_id, 2, 'queued' FROM documents WHERE lang <> 'de'
  UNION ALL SELECT doc_id, 3, 'verifying' FROM verdicts UNION ALL SELECT doc_id, 4, {_STATE} FROM verdicts),
d AS (SELECT doc_id, coalesce(lang <> 'de', false) AS queued FROM documents)
SELECT a.doc_id, step, state, CASE WHEN d.doc_id IS NULL OR step = 1 THEN NULL WHEN step = 2 OR NOT queued THEN 'new'
  WHEN step = 3 THEN 'queued' ELSE 'verifying' END AS before, coalesce(step = 1 OR queued, false) AS accepted
FROM a LEFT JOIN d ON d.doc_id = a.doc_id""")
def st_state_log(t):
    s = Streamed(t, "documents", "labels")

    def step(df, n, state):
        return df.select("doc_id", F.lit(n).alias("step"), state.alias("state"))

    asked = (
        step(s.documents, 1, F.lit("new")).union(step(s.documents.where("lang <> 'de'"), 2, F.lit("queued")))
        .union(step(s.verdicts, 3, F.lit("verifying"))).union(step(s.verdicts, 4, F.expr(_STATE)))
    )
    return run.drain_to_table(keyed.state_log(asked))


@query("st_stall_alarms", "log_lines", """
x AS (SELECT run_id, seq, epoch_us(ts) AS us, line, lag(epoch_us(ts)) OVER w AS was, lag(line) OVER w AS line_before, lead(seq) OVER w AS after
  FROM log_lines WINDOW w AS (PARTITION BY run_id ORDER BY ts, seq)),
g AS (SELECT * FROM x WHERE us > was + 900000000 AND line_before <> 'SESSION ENDED'),
e AS (SELECT * FROM x WHERE after IS NULL AND line <> 'SESSION ENDED'
  AND (us + 900000000) // 1000 < (SELECT max(epoch_us(ts)) FROM log_lines) // 1000)
SELECT run_id, was + 900000000 AS us, 'stalled' AS alarm, was AS last_us FROM g
UNION ALL SELECT run_id, us, 'resumed', was FROM g UNION ALL SELECT run_id, us + 900000000, 'stalled', us FROM e""")
def st_stall_alarms(t):
    lines = Streamed(t, "events").log_lines
    lines = lines.withColumn("ts", C("ts").cast("timestamp")).withWatermark("ts", "0 seconds")
    return run.drain_to_table(keyed.stall_alarms(lines, ended=logs.CLEAN_MARKERS))

"""Ordered log analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from tieproof.catalog.base import query, s_strip, s_text
from tieproof.operators import logs

C = F.col


def s_rate(log: str, hit: str, name: str) -> str:
    return f"""SELECT event_id, session_id, CASE WHEN count(*) OVER w = 20 THEN count(*) FILTER ({hit}) OVER w / 20 END AS {name}
FROM {log} WINDOW w AS (PARTITION BY session_id ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""


@query("wn_last_n_rate", "call_log", s_rate("call_log", "outcome = 'parsed'", "parse_rate"))
def wn_last_n_rate(t):
    return logs.last_n_rate(t.call_log, C("outcome") == "parsed", "parse_rate").select(
        "event_id", "session_id", "parse_rate")


@query("wn_last_n_fail_rate", "fetch_log", s_rate("fetch_log", "outcome <> 'ok'", "fail_rate"))
def wn_last_n_fail_rate(t):
    return logs.last_n_rate(t.fetch_log, C("outcome") != "ok", "fail_rate").select("event_id", "session_id", "fail_rate")


@query("wn_recent_echo", "call_log", """
SELECT event_id, session_id, count(*) FILTER (outcome = 'prompt_echoed') OVER
  (PARTITION BY session_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS echoes FROM call_log""")
def wn_recent_echo(t):
    return logs.recent_count(t.call_log, C("outcome") == "prompt_echoed", "echoes").select(
        "event_id", "session_id", "echoes")


S_STREAK = """
s1 AS (SELECT *, count(*) FILTER ({ok}) OVER (PARTITION BY session_id ORDER BY ts, event_id) AS island FROM fetch_log),
s2 AS (SELECT *, count(*) FILTER (NOT ({ok})) OVER (PARTITION BY session_id, island ORDER BY ts, event_id) AS fail_streak FROM s1)"""


@query("wn_fail_streak", "fetch_log", S_STREAK.format(ok="outcome = 'ok'") + """
SELECT event_id, session_id, fail_streak, max(fail_streak) OVER (PARTITION BY session_id ORDER BY ts, event_id) >= 5 AS breaker_open
FROM s2""")
def wn_fail_streak(t):
    return logs.fail_streaks(t.fetch_log, C("outcome") == "ok").select(
        "event_id", "session_id", "fail_streak", "breaker_open")


@query("wn_recent_restarts", "log_lines", """
k AS (SELECT *, CASE WHEN line = 'SESSION ENDED' THEN 'clean' WHEN starts_with(line, 'Traceback') THEN 'crash' END AS kind FROM log_lines),
x AS (SELECT seq, epoch_us(ts) AS us, kind AS exit_kind FROM k WHERE kind IS NOT NULL
      UNION ALL SELECT max(seq), epoch_us(arg_max(ts, seq)), 'unknown' FROM k GROUP BY run_id HAVING count(kind) = 0),
y AS (SELECT seq, exit_kind, exit_kind = 'clean' AS clean, count(*) OVER (ORDER BY us RANGE BETWEEN 899999999 PRECEDING AND 1 PRECEDING) AS recent FROM x)
SELECT seq, exit_kind, clean, recent, clean OR recent < 3 AS allowed FROM y""")
def wn_recent_restarts(t):
    return logs.restarts(t.log_lines).select("seq", "exit_kind", "clean", "recent", "allowed")


@query("wn_dry_streak", "call_log", """
r AS (SELECT session_id, round, count(*) FILTER (outcome = 'parsed') AS new_rows FROM call_log GROUP BY ALL),
i AS (SELECT *, count(*) FILTER (new_rows > 0) OVER (PARTITION BY session_id ORDER BY round) AS island FROM r),
d AS (SELECT *, count(*) FILTER (new_rows = 0) OVER (PARTITION BY session_id, island ORDER BY round) AS dry_streak FROM i)
SELECT session_id, round, new_rows, dry_streak,
  CASE WHEN dry_streak > 0 THEN round(least(300 * pow(1.5, dry_streak - 1), 3600), 3) ELSE 0.0 END AS cooldown_s FROM d""")
def wn_dry_streak(t):
    return logs.dry_streaks(t.call_log).select("session_id", "round", "new_rows", "dry_streak", "cooldown_s")


@query("wn_backoff", "fetch_log", S_STREAK.format(ok="http_status = 200") + """
SELECT event_id, session_id, http_status, fail_streak, CASE WHEN http_status = 429
  THEN least(60.0 * pow(2, fail_streak - 1), 600) ELSE least(2.0 * pow(2, fail_streak - 1), 60) END AS delay_s
FROM s2 WHERE http_status <> 200""")
def wn_backoff(t):
    return logs.backoff(t.fetch_log).select("event_id", "session_id", "http_status", "fail_streak", "delay_s")


@query("srt_export", "legacy_records", f"""
SELECT rec_seq, company_name, {s_strip(s_text("concat(evidence, ' | ', description, ' | type=', affiliation_type)"))} AS line
FROM legacy_records ORDER BY lower(company_name), rec_seq""")
def srt_export(t):
    line = F.concat("evidence", F.lit(" | "), "description", F.lit(" | type="), "affiliation_type")
    return t.legacy_records.select("rec_seq", "company_name", F.trim(line).alias("line")).orderBy(
        F.lower("company_name"), "rec_seq")


@query("smp_history", "", """
SELECT event_id, user_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 30""")
def smp_history(t):
    return logs.history(t.events, 30).select("event_id", "user_id", "event_type")


@query("st_alarm_edges", "call_log", """
m AS (SELECT *, CASE WHEN latency_ms >= 900 THEN 1 WHEN latency_ms < 750 THEN 0 END AS mark FROM call_log),
s AS (SELECT *, coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY ts, event_id
     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS a,
   coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY ts, event_id
     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM m)
SELECT event_id, session_id, a = 1 AS alarm, CASE WHEN a = 1 AND b = 0 THEN 'raised' WHEN a = 0 AND b = 1 THEN 'cleared' END AS edge
FROM s""")
def st_alarm_edges(t):
    return logs.alarm_edges(t.call_log, "latency_ms", 900, 750).select("event_id", "session_id", "alarm", "edge")



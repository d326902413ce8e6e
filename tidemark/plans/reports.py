"""Queries of reports folded into states. Roles: a user of the events is a source, a day a run, every fifth day a second attempt of the
run before; what was read is told by the types and values of the day's events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import reports as R
from .registry import query, table

REPORTS = """
e AS (SELECT user_id AS source, date_diff('day', TIMESTAMP '2024-01-01', ts) AS run_no, CAST(floor(epoch(ts)) AS BIGINT) AS t, event_type AS k, value AS v FROM events),
r AS (SELECT source, run_no, CAST(CASE WHEN run_no % 5 = 4 THEN run_no - 1 ELSE run_no END AS VARCHAR) AS logical_id, max(t) AS seen_at,
  CASE WHEN bool_or(k = 'error') AND max(v) < 80 THEN 'failed' WHEN max(v) < 60 THEN 'confirmed_empty' ELSE 'success' END AS status, CASE WHEN bool_or(k = 'click') THEN 'fallback_http' ELSE 'api' END AS method,
  CASE WHEN bool_or(k = 'signup') THEN 'security_policy' ELSE 'none' END AS category, min(v) >= 1 AS applied, bool_or(k IN ('view', 'signup', 'purchase')) AS reconcile, max(v) < 100 AS covered, count(*) > 1 AS complete,
  CASE WHEN max(v) >= 100 THEN 'backfill_window' WHEN max(v) < 20 THEN 'resume_error' ELSE 'natural_end' END AS termination, count(*) AS n_items, CAST(floor(max(v) * 1000) AS BIGINT) AS retry_after, CAST(floor(max(v)) AS BIGINT) AS resume_page FROM e GROUP BY 1, 2),
o AS (SELECT *, status <> 'failed' AS safe, status <> 'failed' AND applied AS ok, status = 'confirmed_empty' AS nil, row_number() OVER (PARTITION BY source ORDER BY run_no) AS nth FROM r)
"""


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("source"), F.datediff(F.to_date("ts"), F.lit("2024-01-01")).cast("bigint").alias("run_no"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t"), F.col("event_type").alias("k"), F.col("value").alias("v"))
    has, top = lambda *kinds: F.bool_or(F.col("k").isin(*kinds)), F.max("v")
    status = F.when(has("error") & (top < 80), "failed").when(top < 60, "confirmed_empty").otherwise("success")
    run = F.col("run_no")
    return e.groupBy("source", "run_no").agg(
        F.max("t").alias("at"), status.alias("status"), F.when(has("click"), "fallback_http").otherwise("api").alias("method"), F.when(has("signup"), "security_policy").otherwise("none").alias("category"),
        (F.min("v") >= 1).alias("applied"), has("view", "signup", "purchase").alias("reconcile"), (top < 100).alias("covered"), (F.count(F.lit(1)) > 1).alias("complete"),
        F.when(top >= 100, "backfill_window").when(top < 20, "resume_error").otherwise("natural_end").alias("termination"), F.count(F.lit(1)).alias("n_items"), F.floor(top * 1000).alias("retry_after"), F.floor(top).alias("resume_page"),
    ).withColumn("logical_id", F.when(run % 5 == 4, run - 1).otherwise(run).cast("string")).withColumn("write_safe", F.col("status") != "failed")


@query(f"""
WITH RECURSIVE {REPORTS}, s AS (
  SELECT source, CAST(0 AS BIGINT) AS nth, CAST(NULL AS BIGINT) AS run_no, CAST(NULL AS BIGINT) AS last_attempt_at, CAST(NULL AS BIGINT) AS last_success_at, CAST(0 AS BIGINT) AS failures, CAST(NULL AS BIGINT) AS fallback_open_until, CAST(NULL AS BIGINT) AS source_open_until,
    CAST(NULL AS BIGINT) AS empty_count, false AS empty_pending, CAST(NULL AS BIGINT) AS e_run, CAST(NULL AS VARCHAR) AS e_logical, false AS backfill_active, CAST(NULL AS BIGINT) AS backfill_started_at, CAST(NULL AS BIGINT) AS resume_page,
    CAST(NULL AS BIGINT) AS last_item_count, CAST(NULL AS BIGINT) AS last_covered_at, CAST(NULL AS BIGINT) AS last_full_at FROM (SELECT DISTINCT source FROM o)
  UNION ALL
  SELECT source, nth, run_no, seen_at, CASE WHEN ok THEN seen_at ELSE last_success_at END,
    CASE WHEN safe THEN 0 WHEN method = 'fallback_http' THEN failures + 1 ELSE failures END, CASE WHEN safe THEN NULL WHEN method = 'fallback_http' AND failures >= 1 THEN seen_at + 10800 ELSE fallback_open_until END,
    CASE WHEN safe THEN NULL WHEN category = 'security_policy' THEN seen_at + greatest(21600, least(604800, retry_after)) ELSE source_open_until END,
    CASE WHEN NOT ok THEN empty_count WHEN NOT nil THEN NULL WHEN twice THEN empty_count + 1 ELSE 1 END, CASE WHEN ok THEN nil AND NOT twice ELSE empty_pending END,
    CASE WHEN NOT ok THEN e_run WHEN nil THEN run_no END, CASE WHEN NOT ok THEN e_logical WHEN nil THEN logical_id END,
    CASE WHEN ok AND whole THEN false WHEN ok AND termination = 'backfill_window' THEN true ELSE backfill_active END, CASE WHEN ok AND whole THEN NULL WHEN ok AND termination = 'backfill_window' THEN coalesce(backfill_started_at, seen_at) ELSE backfill_started_at END,
    CASE WHEN ok AND whole THEN NULL WHEN ok AND termination = 'backfill_window' THEN new_page WHEN NOT ok AND termination = 'resume_error' THEN NULL ELSE resume_page END,
    CASE WHEN sure THEN n_items ELSE last_item_count END, CASE WHEN sure THEN seen_at ELSE last_covered_at END, CASE WHEN sure AND complete THEN seen_at ELSE last_full_at END
  FROM (SELECT *, ok AND whole AND (NOT nil OR twice) AS sure FROM (
    SELECT o.source, o.nth, o.run_no, o.seen_at, o.ok, o.safe, o.nil, o.method, o.category, o.retry_after, o.logical_id, o.termination, o.n_items, o.complete, o.resume_page AS new_page, o.reconcile AND o.covered AS whole, coalesce(o.nil AND s.e_run = o.run_no - 1 AND s.e_logical <> o.logical_id, false) AS twice,
      s.last_success_at, s.failures, s.fallback_open_until, s.source_open_until, s.empty_count, s.empty_pending, s.e_run, s.e_logical, s.backfill_active, s.backfill_started_at, s.resume_page, s.last_item_count, s.last_covered_at, s.last_full_at FROM s JOIN o ON o.source = s.source AND o.nth = s.nth + 1)))
SELECT source, run_no, last_attempt_at, last_success_at, failures, fallback_open_until, source_open_until, empty_count, empty_pending, backfill_active, backfill_started_at, resume_page, last_item_count, last_covered_at, last_full_at FROM s WHERE nth > 0
""")
def report_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-01: the state of every source after every run: circuits, emptiness seen twice, the backfill's cursor, marks."""
    return R.report_states(reports(spark, sf_dir), failures=2).withColumn("source", F.col("source").cast("bigint"))


#: Types of events that a user did not have on a day; counted back from the user's last day.
ABSENCES = f"""
WITH RECURSIVE {REPORTS}, m AS (SELECT o.source, o.run_no, o.nth, o.logical_id, o.seen_at, k.k AS item FROM o, (SELECT DISTINCT k FROM e) k WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.source = o.source AND e.run_no = o.run_no AND e.k = k.k)),
b(source, item, run_no, logical_id, seen, n) AS (
  SELECT source, item, run_no, logical_id, seen_at, 1 FROM m WHERE (source, run_no) IN (SELECT source, max(run_no) FROM o GROUP BY 1)
  UNION ALL SELECT b.source, b.item, m.run_no, m.logical_id, m.seen_at, b.n + 1 FROM b JOIN m ON m.source = b.source AND m.item = b.item AND m.run_no = b.run_no - 1 AND m.logical_id <> b.logical_id AND b.seen - m.seen_at <= 100000),
a AS (SELECT source, item, CAST(least(100, max(n)) AS BIGINT) AS observations FROM b GROUP BY 1, 2)
"""


def _absences(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("source"), F.datediff(F.to_date("ts"), F.lit("2024-01-01")).cast("bigint").alias("run_no"), F.col("event_type").alias("item"), "value")
    looks = reports(spark, sf_dir).select("source", "run_no", "logical_id", "at")
    every = e.select("item").distinct()  # a row per type of event
    missing = looks.select("source", "run_no").join(F.broadcast(every.agg(F.collect_set("item").alias("items"))), F.lit(True)).select("source", "run_no", F.explode("items").alias("item"))
    missing = missing.join(e.select("source", "run_no", "item").distinct(), ["source", "run_no", "item"], "left_anti")
    return R.latest_absences(looks, missing, ttl=100_000), e


@query(ABSENCES + "SELECT source, item, observations FROM a")
def absence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-06, STA-01: in how many runs in a row, no attempt twice and none too old, an item was missing."""
    return _absences(spark, sf_dir)[0]


@query(ABSENCES + """
, p AS (SELECT DISTINCT source, k AS item FROM e WHERE v > 10), l AS (SELECT a.* FROM a JOIN p USING (source, item) WHERE observations >= 2),
g AS (SELECT l.source, count(*) AS gone, (SELECT count(*) FROM p WHERE p.source = l.source) AS n FROM l GROUP BY 1)
SELECT l.source, l.item, l.observations, gone > 20 OR (n >= 5 AND gone > 0.5 * n) AS held FROM l JOIN g USING (source)
""")
def confirmed_absences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC-08: pinned items that two readings have not found, and whether so many are gone that nothing is taken off."""
    absent, e = _absences(spark, sf_dir)
    return R.confirmed_absent(absent, e.where("value > 10").select("source", "item").distinct())


@query(f"""
WITH RECURSIVE {REPORTS}, c AS (SELECT o.source, o.run_no, o.nth, o.logical_id, o.termination AS candidate FROM o WHERE NOT ok),
w(source, run_no, logical_id, candidate, n) AS (
  SELECT source, run_no, logical_id, candidate, 1 FROM c WHERE NOT EXISTS (SELECT 1 FROM c p WHERE p.source = c.source AND p.run_no = c.run_no - 1 AND p.logical_id <> c.logical_id AND p.candidate = c.candidate)
  UNION ALL SELECT c.source, c.run_no, c.logical_id, c.candidate, w.n + 1 FROM w JOIN c ON c.source = w.source AND c.run_no = w.run_no + 1 AND c.logical_id <> w.logical_id AND c.candidate = w.candidate)
SELECT source, run_no, candidate, CAST(least(3, n) AS BIGINT) AS observations FROM w
""")
def shrink_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-01: in how many runs in a row the same destructive change was wanted, up to a limit."""
    r = reports(spark, sf_dir).where("NOT (write_safe AND applied)").select("source", "run_no", "logical_id", F.col("termination").alias("candidate"))
    return R.streaks(r, ["source"], ["candidate"], most=3).select("source", "run_no", "candidate", "observations")

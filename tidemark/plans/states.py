"""Queries of cross-run state. Roles: orders are dated records, events are observations of a user by a type of event."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import fingerprint, hash_bucket, iso
from ..operators import states as S
from .registry import query, table

NOW = "2001-08-05 00:00:00"
FAILURE = "concat(event_type, ' failed for user ', user_id, ' at http://h/', event_id)"
ORDERS = f"""
o AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS id, epoch(o_orderdate) AS p, epoch(TIMESTAMP '{NOW}') AS now, o_orderkey % 6 = 0 AS changed,
  CASE WHEN o_orderkey % 3 = 0 THEN epoch(TIMESTAMP '{NOW}') - (o_orderkey % 200) * 3600 END AS detail, CASE WHEN o_orderkey % 3 = 1 THEN epoch(TIMESTAMP '{NOW}') - (o_orderkey % 7) * 86400 END AS seen FROM orders),
t AS (SELECT *, CASE WHEN greatest(0, now - p) < 691200 THEN 3600 WHEN greatest(0, now - p) < 2678400 THEN 86400 ELSE 604800 END AS step, CAST(('0x' || left(sha256(id), 8)) AS BIGINT) % 7 AS bucket FROM o),
d AS (SELECT *, CASE WHEN changed THEN true WHEN detail IS NOT NULL THEN now - detail >= step WHEN step < 604800 THEN true WHEN seen IS NOT NULL THEN now >= seen + bucket * 86400 ELSE bucket = 0 END AS due FROM t)
"""


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of failure; a signal at one gets through if its value is above five."""
    return table(spark, sf_dir, "events").where("event_type IN ('error', 'signup')").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "user_id", "event_id", (F.col("value") > 5).alias("delivered"))


def _due(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, now = F.col("o_orderkey"), F.lit(NOW).cast("timestamp")
    back = lambda n: F.timestamp_seconds(F.unix_timestamp(now) - n)
    o = table(spark, sf_dir, "orders").withColumn("published", F.col("o_orderdate").cast("timestamp"))
    due = S.refresh_due(k.cast("string"), F.col("published"), k % 6 == 0, F.when(k % 3 == 0, back(k % 200 * 3600)), F.when(k % 3 == 1, back(k % 7 * 86400)), now)
    return o.select("o_orderkey", "o_custkey", S.refresh_interval(F.col("published"), now).cast("bigint").alias("step"), due.alias("due"))


@query(f"WITH {ORDERS} SELECT o_orderkey, CAST(step AS BIGINT) AS step, due FROM d")
def refresh_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-06: which records are due for another reading, by change, age and last reading."""
    return _due(spark, sf_dir).drop("o_custkey")


@query(f"WITH {ORDERS}, n AS (SELECT o_custkey AS source, id, row_number() OVER (PARTITION BY o_custkey ORDER BY length(id), id) AS nth FROM d JOIN orders USING (o_orderkey) WHERE due) SELECT *, nth <= 20 AS read FROM n")
def refresh_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-03, WIN-04: all due ids with their place in their source, in the order of digit strings, and the first twenty of each
    marked to be read."""
    from pyspark.sql import Window

    key = F.col("o_orderkey").cast("string")
    due = _due(spark, sf_dir).where("due").select(F.col("o_custkey").alias("source"), key.alias("id"))
    place = F.row_number().over(Window.partitionBy("source").orderBy(F.length("id"), "id")).cast("bigint")
    return due.select("source", "id", place.alias("nth")).withColumn("read", F.col("nth") <= 20)


@query("SELECT doc_id, CAST(CAST(('0x' || left(sha256(CAST(doc_id AS VARCHAR)), 8)) AS BIGINT) % 7 AS INT) AS bucket FROM documents")
def archive_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-08: the day of the week on which an old record is first read."""
    return table(spark, sf_dir, "documents").select("doc_id", hash_bucket(F.col("doc_id").cast("string")).alias("bucket"))


@query("SELECT o_orderkey, sha256('=' || o_orderkey || chr(0) || '=' || strftime(o_orderdate + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S') || '+09:00' || chr(0) || '=' || o_orderstatus || chr(0) || '=' || (o_orderpriority = '1-URGENT')) AS fingerprint FROM orders")
def observation_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-11: a hash over the fields that tell a change."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", fingerprint(F.col("o_orderkey"), iso(F.col("o_orderdate").cast("timestamp")), F.col("o_orderstatus"), F.col("o_orderpriority") == "1-URGENT").alias("fingerprint"))


@query("""
WITH e AS (SELECT event_type AS source, user_id AS item, ts, value FROM events), s AS (SELECT source, item, CAST(max(value) AS VARCHAR) AS fp, min(ts) AS first FROM e WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1, 2),
n AS (SELECT source, item, CAST(max(value) AS VARCHAR) AS fp, min(ts) AS first, max(ts) AS detail FROM e WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1, 2)
SELECT coalesce(n.source, s.source) AS source, coalesce(n.item, s.item) AS item, coalesce(n.fp, s.fp) AS fingerprint, CAST(epoch_us(coalesce(s.first, n.first)) AS BIGINT) AS first_us, CAST(epoch_us(n.detail) AS BIGINT) AS detail_us
FROM s FULL JOIN n ON s.source = n.source AND s.item = n.item
""")
def observation_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-01: the observations of a run folded into the state of those before."""
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.col("user_id").alias("item"), F.col("ts").cast("timestamp").alias("ts"), "value")
    no = F.lit(None).cast("timestamp")
    one = lambda x, detail: x.groupBy("source", "item").agg(F.max("value").cast("string").alias("fingerprint"), F.min("ts").alias("first_seen_at"), detail.alias("last_detail_at")).withColumn("published_at", no)
    state, seen = one(e.where("ts < '2024-01-15'"), F.max(no)), one(e.where("ts >= '2024-01-15'"), F.max("ts"))
    out = S.fold_observations(state, seen, ["source", "item"])
    return out.select("source", "item", "fingerprint", F.unix_micros("first_seen_at").alias("first_us"), F.unix_micros("last_detail_at").alias("detail_us"))


@query("SELECT event_type AS source, user_id AS item FROM events WHERE event_id % 2 = 0 UNION SELECT event_type, user_id FROM events WHERE event_type IN ('view', 'click')")
def known_id_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-08, DED-10: observed and pending ids as one set."""
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.col("user_id").alias("item"), "event_id")
    return e.where("event_id % 2 = 0").drop("event_id").union(e.where("source IN ('view', 'click')").drop("event_id")).distinct()


@query("""
WITH m AS (SELECT user_id, max(ts) AS t FROM events WHERE event_type <> 'view' OR user_id % 2 = 0 GROUP BY 1), u AS (SELECT DISTINCT user_id FROM events), x AS (SELECT u.user_id, m.t FROM u LEFT JOIN m USING (user_id))
SELECT CASE WHEN bool_and(t IS NOT NULL) THEN epoch_us(min(t)) END AS mark_us, count(*) AS sources FROM x
""")
def watermark_min_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-06: a global watermark, only if every source has one."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = S.watermark_if_all(e.where("event_type <> 'view' OR user_id % 2 = 0"), e.select("user_id").distinct(), "user_id", "ts")
    return out.select(F.unix_micros("ts").alias("mark_us"), "sources")


@query("""
WITH s AS (SELECT user_id, CASE WHEN user_id % 10 <> 0 THEN CAST(max(ts) AS DATE) END AS last, user_id % 13 = 0 AS pending FROM events GROUP BY 1),
x AS (SELECT *, TIMESTAMP '2024-01-30 20:30:00' + INTERVAL 9 HOUR AS local FROM s), y AS (SELECT *, CAST(greatest(last + 1, CAST(local AS DATE)) AS TIMESTAMP) + INTERVAL 6 HOUR AS nxt FROM x)
SELECT user_id, pending OR last IS NULL OR local >= nxt AS due, CASE WHEN NOT (pending OR last IS NULL OR local >= nxt) THEN strftime(nxt, '%Y-%m-%d %H:%M:%S') END AS next_at FROM y
""")
def reconcile_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-03: the daily full reading at a local hour."""
    k = F.col("user_id")
    s = table(spark, sf_dir, "events").groupBy("user_id").agg(F.to_date(F.max("ts")).alias("last"))
    due, at = S.reconcile_due(F.when(k % 10 != 0, F.col("last")), k % 13 == 0, F.lit("2024-01-30 20:30:00").cast("timestamp"), 6)
    return s.select("user_id", due.alias("due"), F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("next_at"))


@query("""
WITH l AS (SELECT user_id * 1000 + event_id % 50 AS run, max(event_id) AS seq, arg_max(value, event_id) AS value FROM events GROUP BY 1) SELECT run, seq, value FROM l ORDER BY seq DESC LIMIT 100
""")
def run_upsert_last_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-05, WIN-06: run records by id, the latest of each, the last hundred."""
    e = table(spark, sf_dir, "events").select((F.col("user_id") * 1000 + F.col("event_id") % 50).alias("run"), F.col("event_id").alias("seq"), "value")
    return S.last_runs(e, "run", "seq")


#: A chain of delivered signals for each incident: the first that gets through, then always the first a window later.
SIGNALS = r"""
WITH RECURSIVE m AS (SELECT sha256(regexp_replace(regexp_replace(lower(event_type || ' failed for user ' || user_id || ' at http://h/' || event_id), 'https?://\S+', '<url>', 'g'), '\b(?:[0-9a-f]{8,}|\d+)\b', '<value>', 'g')) AS fingerprint, CAST(floor(epoch(ts)) AS BIGINT) AS t, value > 5 AS d FROM events WHERE event_type IN ('error', 'signup')),
g AS (SELECT fingerprint, t, count(*) AS n, bool_or(d) AS delivered FROM m GROUP BY 1, 2),
c(fingerprint, t) AS (SELECT fingerprint, min(t) FROM g WHERE delivered GROUP BY 1 UNION ALL SELECT c.fingerprint, min(g.t) FROM c JOIN g ON g.fingerprint = c.fingerprint AND g.delivered AND g.t >= c.t + 900 GROUP BY 1),
s AS (SELECT g.*, NOT coalesce(g.t - c.t < 900, false) AS signals FROM g ASOF LEFT JOIN c ON g.fingerprint = c.fingerprint AND g.t > c.t)
"""


@query(SIGNALS + """
SELECT fingerprint, CAST(sum(n) AS BIGINT) AS n, count(*) FILTER (signals) AS signals, count(*) FILTER (signals AND delivered) AS delivered, max(t) AS last_at, max(t) FILTER (signals AND delivered) AS last_signal_at FROM s GROUP BY 1
""")
def incident_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-05: incidents by what is stable in their messages; one is signalled again when a time has gone by since the last
    signal that got through."""
    return S.incidents(_failures(spark, sf_dir), F.expr(FAILURE), "ts", 900, "delivered")


@query(SIGNALS + "SELECT fingerprint, t, n, delivered FROM s WHERE signals")
def incident_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-05, STA-09: the messages that signal, and whether that got through."""
    x = _failures(spark, sf_dir).select(S.incident_key(F.expr(FAILURE)).alias("fingerprint"), F.unix_timestamp("ts").alias("t"), "delivered")
    return S.repeat_signals(x, ["fingerprint"], "t", 900, "delivered").where("signals").drop("signals")


@query("""
WITH e AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'source' WHEN 1 THEN 'destination' ELSE '' END AS origin, CASE WHEN o_custkey % 5 = 0 THEN 'access_block' WHEN o_custkey % 5 = 1 THEN 'contract' ELSE '' END AS kind,
  CASE o_custkey % 7 WHEN 0 THEN 429 WHEN 1 THEN 401 WHEN 2 THEN 404 WHEN 3 THEN 500 END AS status, lower(o_comment) AS m FROM (SELECT *, o_orderpriority || CASE o_orderkey % 3 WHEN 0 THEN ' read Timeout' WHEN 1 THEN ' Blocked by policy' ELSE '' END AS o_comment FROM orders))
SELECT o_orderkey, CASE WHEN origin = 'source' THEN CASE WHEN kind = 'access_block' THEN 'security_policy' ELSE 'source_upstream' END
  WHEN origin = 'destination' THEN CASE WHEN kind = 'contract' THEN 'destination_contract' WHEN status = 429 THEN 'destination_rate_limit' WHEN status IN (401, 403) THEN 'destination_auth' WHEN status BETWEEN 400 AND 499 THEN 'destination_contract' ELSE 'destination' END
  WHEN contains(m, 'blocked') THEN 'security_policy' WHEN contains(m, 'timeout') THEN 'network' ELSE 'internal' END AS category FROM e
""")
def error_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-06: the category of a failure, by where it came from, its kind and its status, else by its message."""
    k, c, none = F.col("o_orderkey"), F.col("o_custkey"), F.lit("")
    origin = F.when(k % 4 == 0, "source").when(k % 4 == 1, "destination").otherwise(none)
    kind = F.when(c % 5 == 0, "access_block").when(c % 5 == 1, "contract").otherwise(none)
    status = F.when(c % 7 == 0, 429).when(c % 7 == 1, 401).when(c % 7 == 2, 404).when(c % 7 == 3, 500)
    text = F.concat("o_orderpriority", F.when(k % 3 == 0, " read Timeout").when(k % 3 == 1, " Blocked by policy").otherwise(none))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.failure_category(origin, kind, status, none, text).alias("category"))

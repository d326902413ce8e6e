"""Queries of change planning. Roles: documents are items and, altered by rule, the destination; orders are dated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import LINE_END, WS, first_line
from ..functions.values import fingerprint
from ..operators import changes as C
from .registry import query, table

QUARANTINED = ["src3"]

#: First non-blank line, in DuckDB.
FIRST_LINE = f"coalesce(list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '{LINE_END}'), lambda x: regexp_replace(x, '^{WS}+|{WS}+$', '', 'g')), lambda x: x <> '')[1], '')"
ITEMS_SQL = f"items AS (SELECT source, doc_id AS item_id, left({FIRST_LINE}, 300) AS title, sha256(coalesce(text, '')) AS body_hash FROM documents)"
DEST_SQL = "dest AS (SELECT source, item_id, CASE WHEN item_id % 11 = 0 THEN title || ' (old)' ELSE title END AS title, CASE WHEN item_id % 7 = 0 THEN sha256(body_hash) ELSE body_hash END AS body_hash FROM items WHERE item_id % 5 <> 0)"


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("source", F.col("doc_id").alias("item_id"), F.left(first_line("text"), F.lit(300)).alias("title"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("body_hash"))


def destination(x: DataFrame) -> DataFrame:
    """An earlier state: a fifth is missing, some titles and bodies differ."""
    title = F.when(F.col("item_id") % 11 == 0, F.concat("title", F.lit(" (old)"))).otherwise(F.col("title"))
    body = F.when(F.col("item_id") % 7 == 0, F.sha2("body_hash", 256)).otherwise(F.col("body_hash"))
    return x.where("item_id % 5 <> 0").select("source", "item_id", title.alias("title"), body.alias("body_hash"))


@query(f"""
WITH {ITEMS_SQL}, {DEST_SQL}, x AS (
  SELECT i.source, i.item_id, d.item_id IS NOT NULL AS known, i.title IS DISTINCT FROM d.title AS t, i.body_hash IS DISTINCT FROM d.body_hash AS b,
    i.item_id % 2 = 0 AS seen, i.source IN ('src3') AS q FROM items i LEFT JOIN dest d ON i.source = d.source AND i.item_id = d.item_id)
SELECT source, item_id, 'conflict' AS kind, 'source_quarantined' AS reason FROM x WHERE q
UNION ALL SELECT source, item_id, 'conflict', 'unconfirmed_change' FROM x WHERE NOT q AND known AND b AND NOT seen
UNION ALL SELECT source, item_id, 'create', 'absent' FROM x WHERE NOT q AND NOT known
UNION ALL SELECT source, item_id, 'update_properties', 'title' FROM x WHERE NOT q AND known AND t AND NOT (b AND NOT seen)
UNION ALL SELECT source, item_id, 'replace_body', 'body_hash' FROM x WHERE NOT q AND known AND b AND seen
UNION ALL SELECT source, item_id, 'noop', 'equal' FROM x WHERE NOT q AND known AND NOT t AND NOT b
""")
def mutation_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC-01, JON-01: creations, updates, replacements, conflicts and no-ops."""
    x = items(spark, sf_dir)
    return C.mutation_plan(x, destination(x), x.where("item_id % 2 = 0"), QUARANTINED)


@query(f"""
WITH {ITEMS_SQL}, {DEST_SQL}, j AS (SELECT i.source, i.item_id, i.title <> d.title AS t, i.body_hash <> d.body_hash AS b FROM items i JOIN dest d ON i.source = d.source AND i.item_id = d.item_id)
SELECT source, item_id, 'title' AS property FROM j WHERE t UNION ALL SELECT source, item_id, 'body_hash' FROM j WHERE b
""")
def property_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC-04: columns that differ."""
    x = items(spark, sf_dir)
    return C.property_diff(x, destination(x), {"title": "text", "body_hash": "text"})


@query("""
SELECT o_orderkey AS item_id FROM orders
WHERE date_trunc('minute', o_orderdate) <> date_trunc('minute', CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 90 SECOND WHEN o_orderkey % 3 = 1 THEN o_orderdate + INTERVAL 30 SECOND ELSE o_orderdate END)
""")
def date_minute_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC-04: dates are compared in UTC at minute precision."""
    o = table(spark, sf_dir, "orders").select(F.lit("orders").alias("source"), F.col("o_orderkey").alias("item_id"), F.col("o_orderdate").cast("timestamp").alias("at"))
    late = F.when(F.col("item_id") % 3 == 0, 90).when(F.col("item_id") % 3 == 1, 30).otherwise(0)
    old = o.withColumn("at", F.timestamp_seconds(F.unix_timestamp("at") + late))
    return C.property_diff(o, old, {"at": "minute"}).select("item_id")


@query("""
WITH s AS (SELECT doc_id AS item_id, source, doc_id % 4 AS run, doc_id % 3 AS logical, (doc_id * 37) % 15000 AS age FROM documents)
SELECT source, item_id, run = 1 AND logical = 1 AND age BETWEEN 0 AND 10800 AS confirmed FROM s
""")
def destructive_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC-05, CDC-06: a change is confirmed by the directly preceding, different logical run within the time limit."""
    d = table(spark, sf_dir, "documents")
    now = F.timestamp_seconds(F.lit(1_700_000_000))
    run, logical = (F.col("doc_id") % 4).cast("string"), (F.col("doc_id") % 3).cast("string")
    seen = F.timestamp_seconds(F.lit(1_700_000_000) - (F.col("doc_id") * 37) % 15000)
    return d.select("source", F.col("doc_id").alias("item_id"), C.consecutive(run, F.lit("1"), logical, F.lit("1"), F.lit("2"), seen, now).alias("confirmed"))


@query("""
WITH dest AS (SELECT o_orderstatus AS source, o_orderkey AS item_id FROM orders WHERE o_orderpriority = '1-URGENT'),
missing AS (SELECT * FROM dest WHERE item_id % 4 = 0),
g AS (SELECT m.source, m.missing, t.pinned, m.missing > 20 OR (t.pinned >= 5 AND m.missing > 0.5 * t.pinned) AS blocked
  FROM (SELECT source, count(*) AS missing FROM missing GROUP BY 1) m JOIN (SELECT source, count(*) AS pinned FROM dest GROUP BY 1) t USING (source))
SELECT m.source, m.item_id, g.missing, g.pinned, g.blocked FROM missing m JOIN g USING (source)
""")
def pinned_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-03, CDC-08, AGG-10: pinned rows that are gone, and whether so many may be cleared."""
    pinned = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderstatus").alias("source"), F.col("o_orderkey").alias("item_id"))
    return C.missing_pinned(pinned, pinned.where("item_id % 4 <> 0"))


@query("""
SELECT 'customer' AS source, c_custkey AS item_id, coalesce(n, 0) AS matches, CASE WHEN n IS NULL THEN 'absent' WHEN n = 1 THEN 'found' ELSE 'ambiguous' END AS status
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey
""")
def lookup_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-01, JON-02: lookups by key, with more than one match told apart."""
    items = table(spark, sf_dir, "customer").select(F.lit("customer").alias("source"), F.col("c_custkey").alias("item_id"))
    dest = table(spark, sf_dir, "orders").select(F.lit("customer").alias("source"), F.col("o_custkey").alias("item_id"))
    return C.lookup(items, dest).withColumn("status", F.when(F.col("matches") == 0, "absent").when(F.col("matches") == 1, "found").otherwise("ambiguous"))


@query("""
SELECT DISTINCT source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AND d.doc_id % 50 = 0
UNION SELECT DISTINCT source FROM documents d JOIN labels l USING (doc_id) WHERE toxic = 1 AND quality = 0
""")
def quarantine_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-04: sources with a pending row that has no item, or with an unconfirmed destructive change."""
    d, l = table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels")
    pending = d.where("doc_id % 50 = 0").join(l, "doc_id", "left_anti")
    return pending.unionByName(d.join(l.where("toxic = 1 AND quality = 0"), "doc_id", "left_semi")).select("source").distinct()


@query("""
WITH w AS (SELECT o_custkey AS url, o_orderpriority AS sha, o_orderkey AS id, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS nth FROM orders WHERE o_orderkey % 2 = 0),
s AS (SELECT o_custkey AS url, o_orderpriority AS sha, o_orderkey AS stored_id, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS nth FROM orders WHERE o_orderkey % 2 = 1)
SELECT w.id, s.stored_id, CASE WHEN s.stored_id IS NULL THEN 'upload' ELSE 'reuse' END AS action FROM w LEFT JOIN s USING (url, sha, nth)
""")
def upload_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED-06, CDC-12: every stored upload is used again once at most."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("url"), F.col("o_orderpriority").alias("sha"), F.col("o_orderkey").alias("id"))
    return C.reusable_uploads(o.where("id % 2 = 0"), o.where("id % 2 = 1"), ["url", "sha"], "id").select("id", "stored_id", "action")


@query(f"""
WITH {ITEMS_SQL}, g AS (SELECT title, body_hash, count(*) AS n, min(item_id) AS first_id FROM items GROUP BY 1, 2)
SELECT i.source, i.item_id, CASE WHEN g.n > 1 AND i.item_id <> g.first_id THEN 'duplicate' WHEN i.title = '' THEN 'unmarked' ELSE 'migrate' END AS action, left(i.title, 160) AS preview,
  sha256('=' || i.source || chr(0) || '=' || i.item_id || chr(0) || '=' || i.body_hash) AS seal
FROM items i JOIN g ON i.title = g.title AND i.body_hash = g.body_hash
""")
def migration_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC-11, AGG-04, PRJ-15: a plan to be reviewed, sealed row by row, with duplicate identities told."""
    x = items(spark, sf_dir)
    g = x.groupBy("title", "body_hash").agg(F.count(F.lit(1)).alias("n"), F.min("item_id").alias("first_id"))
    action = F.when((F.col("n") > 1) & (F.col("item_id") != F.col("first_id")), "duplicate").when(F.col("title") == "", "unmarked").otherwise("migrate")
    return x.join(g, ["title", "body_hash"]).select("source", "item_id", action.alias("action"), F.left("title", F.lit(160)).alias("preview"), fingerprint(F.col("source"), F.col("item_id"), F.col("body_hash")).alias("seal"))


@query("SELECT kind, count(*) AS n FROM (SELECT CASE doc_id % 3 WHEN 0 THEN 'noop' WHEN 1 THEN 'create' ELSE 'conflict' END AS kind FROM documents) GROUP BY 1")
def plan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-01, AGG-07: actions by kind."""
    kind = F.when(F.col("doc_id") % 3 == 0, "noop").when(F.col("doc_id") % 3 == 1, "create").otherwise("conflict")
    return table(spark, sf_dir, "documents").groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))

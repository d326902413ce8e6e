"""Queries of the quality gates. Roles: documents are items, labels their completeness, sources the driver's sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import validation as V
from ..functions.values import allowed_host
from .registry import query, table

ITEMS = """
b AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)),
i AS (SELECT source, CAST(substr(source, 4) AS BIGINT) AS source_ord, CAST(doc_id AS VARCHAR) AS item_id, doc_id AS item_ord,
  CASE WHEN doc_id % 17 = 0 THEN 'x' ELSE CAST(doc_id AS VARCHAR) END AS verified_id,
  CASE WHEN doc_id % 29 = 0 THEN '' ELSE 't' END AS title, left(sha256(coalesce(text, '')), 16) AS url,
  CASE WHEN quality = 0 THEN 'partial' ELSE 'complete' END AS completeness,
  CASE WHEN doc_id % 31 = 0 THEN 'unknown' WHEN n_chars < 40 THEN 'confirmed_empty' ELSE 'present' END AS body_status, n_chars // 40 AS n_blocks,
  CASE WHEN toxic = 1 THEN 'unknown' ELSE 'known' END AS attachments_status, lang AS classification, CASE WHEN source = 'src7' THEN 'en' ELSE lang END AS expected FROM b),
r AS (SELECT * FROM i WHERE title <> ''),
issues AS (
  SELECT source, item_id, 'incomplete_item' AS code FROM i WHERE completeness <> 'complete'
  UNION ALL SELECT source, item_id, 'body_completeness_invalid' FROM i WHERE (body_status = 'present' AND n_blocks = 0) OR (body_status = 'confirmed_empty' AND n_blocks > 0) OR body_status = 'unknown'
  UNION ALL SELECT source, item_id, 'attachment_completeness_invalid' FROM i WHERE attachments_status <> 'known'
  UNION ALL SELECT source, item_id, 'invalid_item_identity' FROM i WHERE title = ''
  UNION ALL SELECT source, item_id, 'notice_identity_mismatch' FROM r WHERE verified_id <> item_id
  UNION ALL SELECT source, item_id, 'duplicate_notice_id' FROM (SELECT *, row_number() OVER (PARTITION BY source, item_id ORDER BY item_ord) AS n FROM r) WHERE n > 1
  UNION ALL SELECT source, item_id, 'duplicate_source_url' FROM (SELECT *, row_number() OVER (PARTITION BY source, url ORDER BY item_ord) AS n FROM r) WHERE n > 1
  UNION ALL SELECT source, item_id, 'classification_mismatch' FROM r WHERE classification <> expected
  UNION ALL SELECT source, item_id, 'cross_source_url_collision' FROM (SELECT *, lag(source) OVER (PARTITION BY url ORDER BY source_ord, item_ord) AS p FROM r) WHERE p <> source)
"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    k, key = F.col("doc_id"), F.col("doc_id").cast("string")
    return d.select(
        "source", F.substring("source", 4, 9).cast("bigint").alias("source_ord"), key.alias("item_id"), k.alias("item_ord"), F.when(k % 17 == 0, "x").otherwise(key).alias("verified_id"),
        F.when(k % 29 == 0, "").otherwise("t").alias("title"), F.left(F.sha2(F.coalesce("text", F.lit("")), 256), F.lit(16)).alias("url"), F.when(F.col("quality") == 0, "partial").otherwise("complete").alias("completeness"),
        F.when(k % 31 == 0, "unknown").when(F.col("n_chars") < 40, "confirmed_empty").otherwise("present").alias("body_status"), F.floor(F.col("n_chars") / 40).alias("n_blocks"),
        F.when(F.col("toxic") == 1, "unknown").otherwise("known").alias("attachments_status"), F.lit(False).alias("truncated"), F.col("lang").alias("classification"), F.when(F.col("source") == "src7", "en").otherwise(F.col("lang")).alias("expected"),
    )


@query(f"WITH {ITEMS} SELECT source, item_id, code, true AS fatal FROM issues")
def validate_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-03: nine item codes."""
    return V.item_issues(items(spark, sf_dir))


RESULTS = """
s AS (SELECT source, CAST(substr(source, 4) AS BIGINT) AS k, count(*) AS n_items FROM documents GROUP BY 1),
res AS (SELECT source, k % 2 = 0 AS required, k % 5 <> 0 AS write_safe, k % 3 <> 1 AS reconcile, k % 4 <> 0 AS covered, CASE WHEN k = 4 THEN 'backfill_window' ELSE 'natural_end' END AS termination, k % 6 = 0 AS full_snapshot,
  CASE WHEN k = 9 THEN 'confirmed_empty' ELSE 'success' END AS status, n_items FROM s WHERE k <> 1 UNION ALL
  SELECT source, k % 2 = 0, k % 5 <> 0, k % 3 <> 1, k % 4 <> 0, 'natural_end', k % 6 = 0, 'success', n_items FROM s WHERE k = 8),
ex AS (SELECT source FROM s WHERE k <> 2), pr AS (SELECT source, CASE WHEN k % 7 < 2 THEN n_items * 5 ELSE n_items END AS was FROM s),
si AS (
  SELECT source, 'missing_source_result' AS code FROM ex WHERE source NOT IN (SELECT source FROM res)
  UNION ALL SELECT DISTINCT source, 'unexpected_source_result' FROM res WHERE source NOT IN (SELECT source FROM ex)
  UNION ALL SELECT source, 'duplicate_source' FROM res GROUP BY source HAVING count(*) > 1
  UNION ALL SELECT source, 'required_source_unsafe' FROM res WHERE required AND NOT write_safe
  UNION ALL SELECT source, 'reconcile_incomplete' FROM res WHERE reconcile AND write_safe AND NOT covered AND termination <> 'backfill_window'
  UNION ALL SELECT source, 'atomic_snapshot_unavailable' FROM res WHERE reconcile AND write_safe AND covered AND NOT full_snapshot
  UNION ALL SELECT source, 'unexpected_empty_source' FROM res WHERE status = 'confirmed_empty'
  UNION ALL SELECT source, 'source_count_collapse' FROM res JOIN pr USING (source) WHERE status = 'success' AND covered AND was >= 5 AND n_items < was * 0.25)
"""


def results(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    s = table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n_items")).withColumn("k", F.substring("source", 4, 9).cast("bigint"))
    k = F.col("k")
    cols = [F.col("source"), (k % 2 == 0).alias("required"), (k % 5 != 0).alias("write_safe"), (k % 3 != 1).alias("reconcile"), (k % 4 != 0).alias("covered"), (k % 6 == 0).alias("full_snapshot"), "n_items"]
    ended = F.when(k == 4, "backfill_window").otherwise("natural_end").alias("termination")
    res = s.where("k <> 1").select(*cols, ended, F.when(k == 9, "confirmed_empty").otherwise("success").alias("status"))
    res = res.unionByName(s.where("k = 8").select(*cols, ended, F.lit("success").alias("status")))
    previous = s.select("source", F.when(k % 7 < 2, F.col("n_items") * 5).otherwise(F.col("n_items")).alias("n_items"))
    return res, s.where("k <> 2").select("source"), previous


@query(f"WITH {RESULTS} SELECT source, code, code <> 'atomic_snapshot_unavailable' AS fatal FROM si")
def source_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-03: eight source codes, among them the collapse of a source's count (AGG-02)."""
    return V.source_issues(*results(spark, sf_dir)).select("source", "code", "fatal")


#: Pins are the line items of small quantity, an order's place being theirs; a high discount breaks a pin's address.
PINS = """
l AS (SELECT l_suppkey AS source, CAST(l_partkey AS VARCHAR) AS id, l_orderkey * 10 + l_linenumber AS ord, l_quantity AS q, l_discount AS d, l_tax AS tax FROM lineitem),
v AS (SELECT source, avg(q) > 25.5 AS pins_verified FROM l GROUP BY 1),
p AS (SELECT source, ord, CASE WHEN d < 0.1 OR source % 4 <> 3 THEN id END AS pin_id FROM l JOIN v USING (source) WHERE pins_verified AND q < 3),
f AS (SELECT source, min(ord) AS ord, pin_id FROM p WHERE pin_id IS NOT NULL GROUP BY 1, 3),
t AS (SELECT source, id FROM l JOIN v USING (source) WHERE pins_verified AND tax > 0.07 AND q < 4),
pi AS (
  SELECT source, NULL AS item_id, 'invalid_top_snapshot_url' AS code FROM p WHERE pin_id IS NULL
  UNION ALL SELECT p.source, p.pin_id, 'duplicate_top_snapshot_id' FROM p JOIN f USING (source, pin_id) WHERE p.ord > f.ord
  UNION ALL SELECT source, id, 'top_snapshot_item_mismatch' FROM t WHERE (source, id) NOT IN (SELECT source, pin_id FROM f))
"""


def _pins(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    l = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("source"), F.col("l_partkey").cast("string").alias("item_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pin_ord"), F.col("l_quantity").alias("q"), F.col("l_discount").alias("d"), F.col("l_tax").alias("tax"))
    verified = l.groupBy("source").agg((F.avg("q") > 25.5).alias("pins_verified"))
    pins = l.where("q < 3").select("source", "pin_ord", F.when((F.col("d") < 0.1) | (F.col("source") % 4 != 3), F.col("item_id")).alias("pin_id"))
    return verified, pins, l.where("q < 4").select("source", "item_id", (F.col("tax") > 0.07).alias("pinned"))


@query(f"WITH {PINS} SELECT source, item_id, code, false AS fatal FROM pi")
def snapshot_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-03: the three codes of pinned-list snapshots: wrong addresses, repeated ids, pinned items the snapshot lacks."""
    return V.snapshot_issues(*_pins(spark, sf_dir))


@query(f"WITH {PINS} SELECT source, pins_verified AND source NOT IN (SELECT source FROM pi) AS pins_verified FROM v")
def snapshot_revoked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-03: a source whose snapshot has a fault no longer counts as verified."""
    verified, pins, items = _pins(spark, sf_dir)
    return V.revoke_snapshots(verified, V.snapshot_issues(verified, pins, items)).select("source", "pins_verified")


@query(f"WITH {RESULTS} SELECT DISTINCT source FROM res WHERE write_safe AND source NOT IN (SELECT source FROM si WHERE code NOT IN ('atomic_snapshot_unavailable', 'duplicate_source')) AND source NOT IN (SELECT source FROM si WHERE code = 'duplicate_source')")
def safe_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-04, FLT-05: sources that may be written; here a repeated source counts as its own fault only."""
    res, expected, previous = results(spark, sf_dir)
    found = V.source_issues(res, expected, previous)
    own = found.withColumn("code", F.when(F.col("code") == "duplicate_source", "repeated").otherwise(F.col("code")))
    return V.safe_sources(res, own)


@query(f"""
WITH {RESULTS}, fatal AS (SELECT DISTINCT source, code FROM si WHERE code <> 'atomic_snapshot_unavailable'), g AS (SELECT count(*) > 0 AS stopped FROM fatal WHERE code IN ('duplicate_source', 'cross_source_url_collision')),
o AS (SELECT source, bool_or(write_safe) AS write_safe, source IN (SELECT source FROM fatal) AS faulty FROM res GROUP BY 1)
SELECT source, faulty, stopped, write_safe AND NOT faulty AND NOT stopped AS safe FROM o, g
""")
def global_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-05: which sources have faults of their own, and whether a fatal global code, as a repeated source is, stops all."""
    res, expected, previous = results(spark, sf_dir)
    return V.source_safety(res, V.source_issues(res, expected, previous))


@query("SELECT r_name AS name, 'missing' AS side FROM region WHERE r_regionkey NOT IN (SELECT n_regionkey FROM nation WHERE n_nationkey % 5 <> 2) UNION ALL SELECT DISTINCT n_name, 'unexpected' FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region WHERE r_regionkey <> 3)")
def expected_vs_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED-09: both differences of two key sets."""
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    missing = r.join(n.where("n_nationkey % 5 <> 2"), r.r_regionkey == n.n_regionkey, "left_anti").select(F.col("r_name").alias("name"), F.lit("missing").alias("side"))
    more = n.join(r.where("r_regionkey <> 3"), r.r_regionkey == n.n_regionkey, "left_anti").select(F.col("n_name").alias("name"), F.lit("unexpected").alias("side")).distinct()
    return missing.unionByName(more)


@query("SELECT sha256(coalesce(text, '')) AS identity, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-04, AGG-09: identities that more than one row has."""
    d = table(spark, sf_dir, "documents").groupBy(F.sha2(F.coalesce("text", F.lit("")), 256).alias("identity"))
    return d.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).where("n > 1")


@query("""
WITH c AS (SELECT event_type AS source, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2), w AS (SELECT *, lag(n) OVER (PARTITION BY source ORDER BY day) AS was FROM c)
SELECT source, strftime(day, '%Y-%m-%d') AS day, n, was, was >= 5 AND n < was * 0.9 AS collapsed FROM w WHERE was IS NOT NULL
""")
def count_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-02: counts against those of the run before. The window is over days, of which a source has few."""
    from pyspark.sql import Window

    c = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("source"), F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    w = c.withColumn("was", F.lag("n").over(Window.partitionBy("source").orderBy("day"))).where("was IS NOT NULL")
    return w.select("source", F.date_format("day", "yyyy-MM-dd").alias("day"), "n", "was", ((F.col("was") >= 5) & (F.col("n") < F.col("was") * 0.9)).alias("collapsed"))


@query("""
SELECT doc_id, CASE WHEN n_chars > 100 THEN 'present' WHEN doc_id % 2 = 0 AND doc_id % 3 = 0 THEN 'confirmed_empty' ELSE 'unknown' END AS body_status,
  CASE WHEN doc_id % 20 > 15 THEN 'unknown' WHEN doc_id % 20 = 0 AND doc_id % 40 = 0 THEN 'unknown' ELSE 'known' END AS attachments_status,
  nullif(concat_ws(',', CASE WHEN doc_id % 2 = 1 THEN 'title' END, CASE WHEN doc_id % 5 = 0 THEN 'date' END, CASE WHEN n_chars < 100 THEN 'body' END), '') AS missing FROM documents
""")
def detail_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-13, FLT-14: what is known of a detail, and which fields it lacks."""
    k, n = F.col("doc_id"), F.col("n_chars")
    return table(spark, sf_dir, "documents").select(
        "doc_id", V.body_status((n > 100).cast("int"), k % 2 == 0, k % 3 == 0).alias("body_status"), V.attachments_status(k % 20, k % 40 == 0).alias("attachments_status"),
        V.missing_fields({"title": k % 2 == 1, "date": k % 5 == 0, "body": n < 100}).alias("missing"),
    )


@query("""
WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) AS host FROM pages)
SELECT page_id, host, host = 'example.com' OR host LIKE '%.example.com' OR host = 'example.org' OR host LIKE '%.example.org' AS allowed FROM h
""")
def attachment_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-07: hosts that are a listed domain or below one."""
    host = F.lower(F.regexp_extract("url", "^[a-z]+://([^/:?#]+)", 1))
    return table(spark, sf_dir, "pages").select("page_id", host.alias("host"), allowed_host(host, ["example.com", "example.org"]).alias("allowed"))

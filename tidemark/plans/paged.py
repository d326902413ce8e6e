"""Queries of whole scans of paged lists. Roles: a supplier is a source, its line items by order its list, twenty a page. By supplier
some lists change while they are read, break off, answer for another page, declare another total, or go on from a page."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import paged as P
from .registry import query, table

CAP, SIZE = 31, 20

SCAN = f"""
l AS (SELECT l_suppkey AS source, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_shipdate) AS nth, l_orderkey, l_partkey, l_quantity AS q, l_shipdate AS d, l_discount AS disc, l_tax AS tax, l_returnflag AS f, l_linestatus AS st FROM lineitem),
r1 AS (SELECT source, (nth - 1) // {SIZE} + 1 AS page_no, (nth - 1) % {SIZE} AS pos, CAST(CASE WHEN source % 8 = 1 THEN l_partkey ELSE l_orderkey * 100000 + nth END AS VARCHAR) AS item_id, CAST(CAST(q AS BIGINT) AS VARCHAR) AS title, strftime(d, '%Y-%m-%d') AS date, nth <= 2 AS pinned, f, st, disc, tax FROM l),
r2 AS (SELECT source, page_no, pos, item_id, CASE WHEN source % 8 = 3 AND disc >= 0.1 AND tax >= 0.08 THEN title || '!' ELSE title END AS title, date, pinned FROM r1),
c AS (SELECT source, count(*) AS total, max(page_no) AS last FROM r1 GROUP BY 1),
p AS (SELECT source, page_no, NOT (source % 8 = 7 AND page_no = 11) AS ok, CASE WHEN source % 8 = 4 AND page_no = 9 THEN 8 ELSE page_no END AS echo, total + CASE WHEN source % 16 = 2 AND page_no > 12 THEN 1 ELSE 0 END AS total, CASE WHEN source % 8 <> 6 THEN page_no < last END AS has_more
  FROM c, LATERAL (SELECT unnest(range(1, last + CASE WHEN source % 8 = 6 THEN 2 ELSE 1 END)) AS page_no) WHERE page_no <= {CAP + 1}),
kn AS (SELECT DISTINCT source, item_id FROM r1 WHERE f <> 'R'),
an AS (SELECT source, CASE WHEN source % 16 = 5 THEN '0' ELSE item_id END AS item_id FROM r1 WHERE page_no = 9 AND st = 'F' AND source % 8 IN (0, 5)),
rr AS (SELECT * FROM r1 WHERE page_no <= {CAP}),
s1 AS (SELECT source, page_no, count(*) AS n, string_agg(item_id || '|' || title || '|' || date, '/' ORDER BY pos) AS sig, string_agg(item_id || '|' || pinned, '/' ORDER BY pos) AS seq FROM rr GROUP BY 1, 2),
s2 AS (SELECT source, page_no, string_agg(item_id || '|' || title || '|' || date, '/' ORDER BY pos) AS sig FROM r2 WHERE page_no <= {CAP} GROUP BY 1, 2),
fs AS (SELECT source, item_id, min(page_no * 100 + pos) AS at0, arg_min(title || '|' || date || '|' || pinned, page_no * 100 + pos) AS was FROM rr GROUP BY 1, 2),
x AS (
  SELECT p.*, coalesce(s1.n, 0) AS n, s1.sig, s1.seq, coalesce(lag(coalesce(s1.n, 0)) OVER w < {SIZE}, false) AS short, first_value(total) OVER w AS declared,
    (SELECT count(DISTINCT item_id) FROM rr WHERE rr.source = p.source AND NOT pinned AND rr.page_no <= p.page_no) AS seen, (SELECT count(*) FROM rr WHERE rr.source = p.source AND rr.page_no <= p.page_no) AS listed,
    EXISTS (SELECT 1 FROM s1 e WHERE e.source = p.source AND e.page_no < p.page_no AND e.sig = s1.sig) AS again, EXISTS (SELECT 1 FROM s1 e WHERE e.source = p.source AND e.page_no < p.page_no AND e.seq = s1.seq) AS again_ids,
    EXISTS (SELECT 1 FROM rr JOIN fs USING (source, item_id) WHERE rr.source = p.source AND rr.page_no = p.page_no AND rr.page_no * 100 + rr.pos > at0 AND (NOT pinned OR title || '|' || date || '|' || pinned <> was)) AS collides,
    p.source IN (SELECT source FROM an) AND NOT EXISTS (SELECT 1 FROM rr JOIN an USING (source, item_id) WHERE rr.source = p.source AND rr.page_no BETWEEN 8 AND p.page_no AND NOT rr.pinned) AS unanchored
  FROM p LEFT JOIN s1 USING (source, page_no) WINDOW w AS (PARTITION BY p.source ORDER BY p.page_no)),
y AS (SELECT *, has_more IS FALSE OR (n = 0 AND (page_no = 1 OR short)) AS ends FROM x),
z AS (SELECT source, page_no, CASE WHEN page_no > {CAP} THEN 'hard_cap' WHEN NOT ok THEN 'page_error' WHEN echo <> page_no THEN 'page_echo' WHEN total <> declared THEN 'total_changed' WHEN total < seen THEN 'total_below_observed' WHEN unanchored AND (n = 0 OR page_no > 12) THEN 'resume_anchor_missing'
  WHEN n = 0 AND NOT ends THEN 'empty_unverified' WHEN n > 0 AND again THEN 'repeated_page' WHEN n > 0 AND again_ids THEN 'repeated_ids' WHEN collides THEN 'identity_collision' WHEN ends AND declared <> seen AND declared <> listed THEN 'total_mismatch' WHEN ends THEN 'end' END AS rule FROM y),
st AS (SELECT source, min(page_no) AS stop, arg_min(rule, page_no) AS rule FROM z WHERE rule IS NOT NULL GROUP BY 1),
so AS (SELECT source, coalesce(rule, 'page_error') AS rule, coalesce(stop, (SELECT max(page_no) + 1 FROM p WHERE p.source = c.source)) AS stop FROM c LEFT JOIN st USING (source)),
ch AS (SELECT s1.source, min(s1.page_no) AS changed FROM s1 JOIN s2 USING (source, page_no) JOIN so USING (source) WHERE so.rule = 'end' AND s1.page_no <= so.stop AND s1.sig <> s2.sig GROUP BY 1),
ct AS (SELECT rr.*, (rr.source, rr.item_id) NOT IN (SELECT source, item_id FROM kn) AND rr.page_no * 100 + rr.pos = at0 AS fresh FROM rr JOIN fs USING (source, item_id) JOIN so ON so.source = rr.source AND rr.page_no <= CASE WHEN so.rule = 'end' THEN so.stop ELSE so.stop - 1 END),
qu AS (SELECT source, page_no, pos, row_number() OVER (PARTITION BY source ORDER BY page_no, pos) AS nth FROM ct WHERE fresh AND NOT pinned),
nx AS (SELECT source, page_no AS resume_page FROM qu WHERE nth = 21),
ob AS (SELECT source, count(DISTINCT item_id) AS observed FROM ct GROUP BY 1)
"""


def lists(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    order = Window.partitionBy("source").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    l = table(spark, sf_dir, "lineitem").withColumn("source", F.col("l_suppkey")).repartition(parts, "source").withColumn("nth", F.row_number().over(order).cast("bigint"))
    kind = F.col("source") % 8
    item = F.when(kind == 1, F.col("l_partkey")).otherwise(F.col("l_orderkey") * 100_000 + F.col("nth")).cast("string")
    r = l.select("source", F.floor((F.col("nth") - 1) / SIZE + 1).alias("page_no"), ((F.col("nth") - 1) % SIZE).alias("pos"), item.alias("item_id"), F.col("l_quantity").cast("bigint").cast("string").alias("title"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"), (F.col("nth") <= 2).alias("pinned"), "l_returnflag", "l_linestatus", "l_discount", "l_tax")
    r = r.persist(StorageLevel.DISK_ONLY)  # ranked once, and dealt by source, by which a scan groups and joins
    changed = F.when((kind == 3) & (F.col("l_discount") >= 0.1) & (F.col("l_tax") >= 0.08), F.concat("title", F.lit("!"))).otherwise(F.col("title"))
    names = ["source", "reading", "page_no", "pos", "item_id", "title", "date", "pinned"]
    rows = r.withColumn("reading", F.lit(1)).select(names).unionByName(r.withColumn("title", changed).withColumn("reading", F.lit(2)).select(names))
    counts = r.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.max("page_no").alias("last"))
    page = F.col("page_no")
    pages = counts.select("source", "n", "last", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("last") + (kind == 6).cast("bigint"))).alias("page_no"))
    pages = pages.select("source", F.explode(F.array(F.lit(1), F.lit(2))).alias("reading"), "page_no", (~((kind == 7) & (page == 11))).alias("ok"), F.when((kind == 4) & (page == 9), 8).otherwise(page).alias("echo"), (F.col("n") + ((F.col("source") % 16 == 2) & (page > 12)).cast("bigint")).alias("total"), F.when(kind != 6, page < F.col("last")).alias("has_more"))
    known = r.where("l_returnflag <> 'R'").select("source", "item_id")
    from_page = r.where((page == 9) & (F.col("l_linestatus") == "F") & kind.isin(0, 5)).groupBy("source").agg(F.collect_set(F.when(F.col("source") % 16 == 5, "0").otherwise(F.col("item_id"))).alias("anchors"))
    return pages, rows, known, from_page.withColumn("resume_page", F.lit(10).cast("bigint"))


@query(f"""
WITH {SCAN}
SELECT source, CASE WHEN rule <> 'end' OR changed IS NOT NULL THEN 'partial' ELSE 'success' END AS status,
  CASE WHEN changed IS NOT NULL THEN 'snapshot_changed' WHEN rule = 'hard_cap' THEN 'hard_cap' WHEN rule = 'resume_anchor_missing' THEN 'resume_error' WHEN rule <> 'end' THEN 'page_error' WHEN resume_page IS NOT NULL THEN 'backfill_window' ELSE 'natural_end' END AS reason,
  CASE WHEN changed IS NOT NULL THEN 'snapshot_changed:' || changed WHEN rule <> 'end' THEN rule || ':' || stop END AS error, CASE WHEN rule IN ('hard_cap', 'page_error', 'page_echo') THEN stop - 1 ELSE stop END AS pages_scanned, coalesce(observed, 0) AS observed, resume_page
FROM so LEFT JOIN ch USING (source) LEFT JOIN nx USING (source) LEFT JOIN ob USING (source)
""")
def scan_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-05, SRC-06: where the scan of each source ends, why, and where the next one goes on."""
    result, _ = P.scan(*lists(spark, sf_dir), cap=CAP, size=SIZE)
    return result.drop("anchors")


@query(f"WITH {SCAN} SELECT ct.source, ct.page_no, ct.pos, ct.item_id, ct.pinned, fresh AND (ct.pinned OR coalesce(nth <= 20, false)) AS read FROM ct LEFT JOIN qu USING (source, page_no, pos)")
def scan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-05, WIN-01: the rows of each scan that count, and which of them are read in detail."""
    return P.scan(*lists(spark, sf_dir), cap=CAP, size=SIZE)[1]


@query(f"WITH {SCAN} SELECT nx.source, nx.resume_page, rr.item_id AS anchor FROM nx JOIN rr ON rr.source = nx.source AND rr.page_no = nx.resume_page AND NOT rr.pinned GROUP BY ALL")
def scan_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-05: the page where the next scan goes on, with the ids by which it will be known again."""
    result, _ = P.scan(*lists(spark, sf_dir), cap=CAP, size=SIZE)
    return result.where("resume_page IS NOT NULL").select("source", "resume_page", F.explode("anchors").alias("anchor"))

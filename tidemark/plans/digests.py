"""Queries of located differences and of figures of a run. Roles: documents are items and, altered by rule, the destination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import digests as D
from .changes import DEST_SQL, ITEMS_SQL, destination, items
from .registry import query, table

KEYS, COLUMNS = ["source", "item_id"], ["title", "body_hash"]


@query(f"""
WITH {ITEMS_SQL}, {DEST_SQL}
SELECT source, item_id, kind, columns FROM (
  SELECT coalesce(d.source, i.source) AS source, coalesce(d.item_id, i.item_id) AS item_id, CASE WHEN i.item_id IS NULL THEN 'missing' WHEN d.item_id IS NULL THEN 'extra' WHEN i.title <> d.title OR i.body_hash <> d.body_hash THEN 'changed' END AS kind,
    concat_ws(',', CASE WHEN i.title <> d.title THEN 'title' END, CASE WHEN i.body_hash <> d.body_hash THEN 'body_hash' END) AS columns
  FROM dest d FULL JOIN (SELECT * FROM items WHERE item_id % 13 <> 0) i ON i.source = d.source AND i.item_id = d.item_id) WHERE kind IS NOT NULL
""")
def located_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC-07, STA-04: where a destination differs from what it should be, read in the key ranges whose digests differ."""
    x = items(spark, sf_dir)
    out = D.differences(destination(x), x.where("item_id % 13 <> 0"), KEYS, COLUMNS, 64)
    return out.withColumn("columns", F.array_join("columns", ","))


@query(f"""
WITH {ITEMS_SQL}, {DEST_SQL}, p AS (SELECT i.source, i.item_id, CASE WHEN d.item_id IS NULL THEN 'create' ELSE 'update' END AS action, d.title AS old FROM items i LEFT JOIN dest d USING (source, item_id) WHERE d.item_id IS NULL OR d.title <> i.title OR d.body_hash <> i.body_hash)
SELECT source, item_id, -item_id AS undo_order, CASE WHEN action = 'create' THEN 'archive' ELSE 'restore' END AS undo, old AS title FROM p JOIN labels l ON l.doc_id = item_id
""")
def plan_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC-11: the steps of a plan that were applied, undone from the last to the first."""
    x = items(spark, sf_dir)
    old = destination(x)
    plan = D.differences(old, x, KEYS, COLUMNS, 64).withColumn("action", F.when(F.col("kind") == "extra", "create").otherwise("update")).withColumn("step", F.col("item_id"))
    applied = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("item_id")).join(x.select(*KEYS), "item_id").select(*KEYS)
    return D.rollback(plan, applied, old, KEYS, "step").select(*KEYS, "undo_order", "undo", F.col("restore.title").alias("title"))


@query("""
WITH m AS (SELECT o_orderkey % 7 = 0 AS create_, o_totalprice AS price, o_orderpriority AS p FROM orders)
SELECT 'rows' AS figure, count(*) AS n FROM m UNION ALL SELECT 'urgent', count(*) FILTER (p = '1-URGENT') FROM m UNION ALL SELECT 'costly', count(*) FILTER (price > 300000) FROM m UNION ALL SELECT 'most', CAST(floor(max(price)) AS BIGINT) FROM m
""")
def run_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-06, AGG-06: figures of a run, observed in the pass that writes its rows."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    _, seen = D.measured(o, {"rows": F.count(F.lit(1)), "urgent": F.count_if(F.col("o_orderpriority") == "1-URGENT"), "costly": F.count_if(F.col("o_totalprice") > 300_000), "most": F.floor(F.max("o_totalprice"))})
    return spark.createDataFrame([(k, int(v)) for k, v in seen.items()], "figure string, n long")

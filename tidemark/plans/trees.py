"""Queries of nested blocks and of conflicts. Roles: a document is a block below that whose number is its own over two to four, told by
its length; a source's labels are what is on record of its media; orders of one customer look each other up by two keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import trees as T
from .registry import query, table

BLOCKS = """
b AS (SELECT doc_id AS id, CASE WHEN doc_id = 0 OR n_chars % 50 = 0 THEN NULL WHEN n_chars % 97 = 0 THEN -1 ELSE doc_id // (2 + n_chars % 3) END AS parent, doc_id AS pos, sha256(coalesce(lang, '-')) AS own FROM documents),
d AS (SELECT id, id AS root, 0 AS depth, parent AS container FROM b WHERE parent IS NULL UNION ALL SELECT b.id, d.root, d.depth + 1, b.parent FROM d JOIN b ON b.parent = d.id WHERE d.depth < {depth})
"""


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("doc_id"), F.col("n_chars")
    parent = F.when((k == 0) | (n % 50 == 0), None).when(n % 97 == 0, -1).otherwise(F.floor(k / (2 + n % 3)))
    return table(spark, sf_dir, "documents").select(k.alias("id"), parent.cast("bigint").alias("parent"), k.alias("pos"), "lang", "n_chars")


@query("WITH RECURSIVE " + BLOCKS.format(depth=50) + "SELECT id, root, depth, container FROM d")
def nested_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-17: all blocks below each page, at any depth."""
    return T.descend(blocks(spark, sf_dir))


@query("WITH RECURSIVE " + BLOCKS.format(depth=4) + """
SELECT id, parent, CASE WHEN parent NOT IN (SELECT id FROM b) THEN 'orphan' WHEN parent IN (SELECT id FROM d WHERE depth = 4) THEN 'too_deep' ELSE 'unreached' END AS why FROM b WHERE id NOT IN (SELECT id FROM d)
""")
def unreached_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-17: blocks that a descent of four levels does not reach, and why."""
    b = blocks(spark, sf_dir)
    return T.cut_off(b, T.descend(b, 4), 4)


@query("WITH RECURSIVE " + BLOCKS.format(depth=50) + """,
n AS (SELECT b.id, b.parent, b.pos, b.own, d.depth FROM b JOIN d USING (id)),
s(id, parent, pos, depth, signature) AS (
  SELECT id, parent, pos, depth, sha256(own || ':') FROM n WHERE depth = (SELECT max(depth) FROM n)
  UNION ALL SELECT n.id, n.parent, n.pos, n.depth, sha256(n.own || ':' || coalesce(c.children, ''))
  FROM n LEFT JOIN (SELECT parent, string_agg(hash, ',' ORDER BY part) AS children FROM (SELECT parent, pos // 1024 AS part, sha256(string_agg(signature, ',' ORDER BY pos)) AS hash FROM s GROUP BY 1, 2) GROUP BY 1) c ON c.parent = n.id
  WHERE n.depth = (SELECT max(depth) - 1 FROM s))
SELECT id, signature FROM s
""")
def subtree_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HSH-03: a hash of every block with all that is below it, in order."""
    return T.signatures(blocks(spark, sf_dir), F.coalesce("lang", F.lit("-")))


@query("WITH RECURSIVE " + BLOCKS.format(depth=50) + """,
live AS (SELECT doc_id AS id, lang AS kind, CAST(n_chars // 10 AS VARCHAR) AS key FROM documents WHERE n_chars % 3 = 0), th AS (SELECT live.*, root FROM live JOIN d USING (id)),
st AS (SELECT d.root, d.id, CASE WHEN toxic = 1 THEN 'xx' ELSE lang END AS kind, CASE WHEN quality = 0 AND doc_id % 4 = 0 THEN NULL ELSE CAST(n_chars // 10 AS VARCHAR) END AS key FROM documents JOIN d ON d.id = doc_id LEFT JOIN labels USING (doc_id) WHERE n_chars % 3 = 0 AND n_chars % 7 <> 0),
k AS (SELECT root, count(*) AS n_stored, count(*) FILTER (key IS NULL) AS no_key, count(DISTINCT key) AS n_keys FROM st GROUP BY 1), c AS (SELECT root, count(*) AS n_live FROM th GROUP BY 1),
w AS (SELECT st.root, count(*) AS wrong FROM st LEFT JOIN th USING (root, id) WHERE th.kind IS NULL OR st.kind IS DISTINCT FROM th.kind OR st.key IS DISTINCT FROM th.key GROUP BY 1)
SELECT root, coalesce(n_live, 0) AS n_live, coalesce(n_stored, 0) AS n_stored, CASE WHEN coalesce(n_live, 0) <> coalesce(n_stored, 0) THEN 'drift' WHEN no_key > 0 OR n_keys < n_stored THEN 'unavailable' WHEN wrong > 0 THEN 'drift' ELSE 'valid' END AS status FROM c FULL JOIN k USING (root) LEFT JOIN w USING (root)
""")
def nested_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-07: media in containers at any depth against what is on record for their page."""
    b = blocks(spark, sf_dir)
    reached, key = T.descend(b), F.floor(F.col("n_chars") / 10).cast("bigint").cast("string")
    live = b.where("n_chars % 3 = 0").select("id", F.col("lang").alias("kind"), key.alias("key"))
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id")
    kept = b.where("n_chars % 3 = 0 AND n_chars % 7 <> 0").join(labels, "id", "left").join(reached.select("id", "root"), "id")
    stored = kept.select("root", "id", F.when(F.col("toxic") == 1, "xx").otherwise(F.col("lang")).alias("kind"), F.when((F.col("quality") == 0) & (F.col("id") % 4 == 0), None).otherwise(key).alias("key"))
    return T.held_media(reached, live, stored)


@query("""
WITH RECURSIVE i AS (SELECT * FROM orders WHERE o_orderstatus <> 'F'), r AS (SELECT * FROM orders WHERE o_orderstatus = 'F'),
e AS (SELECT DISTINCT i.o_orderkey AS item, r.o_orderkey AS row FROM i JOIN r ON i.o_custkey = r.o_custkey AND (i.o_orderpriority = r.o_orderpriority AND year(i.o_orderdate) = year(r.o_orderdate) OR date_trunc('month', i.o_orderdate) = date_trunc('month', r.o_orderdate))),
n AS (SELECT item AS a, item AS b FROM e UNION SELECT n.a, e2.item FROM n JOIN e e1 ON e1.item = n.b JOIN e e2 ON e2.row = e1.row),
l AS (SELECT a AS item, min(b) AS conflict FROM n GROUP BY 1), g AS (SELECT DISTINCT l.conflict FROM l JOIN e USING (item) GROUP BY l.conflict HAVING count(*) > 1)
SELECT 'item' AS side, item AS id, conflict FROM l WHERE conflict IN (SELECT conflict FROM g) UNION SELECT 'row', e.row, l.conflict FROM e JOIN l USING (item) WHERE l.conflict IN (SELECT conflict FROM g)
""")
def lookup_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-02: destination rows that serve several items, and items with several rows, as groups with their members."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", F.year("o_orderdate").alias("y"), F.trunc("o_orderdate", "month").alias("m"))
    i, r = o.where("o_orderstatus <> 'F'").withColumnRenamed("o_orderkey", "item"), o.where("o_orderstatus = 'F'").withColumnRenamed("o_orderkey", "row")
    edges = i.join(r, ["o_custkey", "o_orderpriority", "y"]).select("item", "row").union(i.join(r, ["o_custkey", "m"]).select("item", "row"))
    return T.conflict_groups(edges)

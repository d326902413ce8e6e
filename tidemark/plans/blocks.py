"""Queries of ordered blocks. Roles: a conversation is an item, its turns are blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import blocks as B
from .registry import query, table


@query("SELECT conv_id, sha256(string_agg('=' || role || chr(31) || '=' || text, chr(30) ORDER BY turn)) AS body_hash, CAST(count(*) AS INT) AS n_blocks FROM conversations GROUP BY 1")
def body_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HSH-01, HSH-03: a hash over blocks in order."""
    return B.body_hash(table(spark, sf_dir, "conversations"), "conv_id", "turn", ["role", "text"])


@query("""
WITH b AS (SELECT conv_id, turn, CASE WHEN turn >= 3 THEN '  ' ELSE text || ' ' || chr(160) END AS text FROM conversations), l AS (SELECT conv_id, max(turn) FILTER (trim(text) <> '') AS last FROM b GROUP BY 1)
SELECT conv_id, CAST(turn AS INT) AS ix, CASE WHEN turn = last THEN regexp_replace(text, '[\\s\\x{a0}]+$', '') ELSE text END AS text FROM b JOIN l USING (conv_id) WHERE turn <= last
""".replace("\\\\", "\\"))
def trim_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ARR-01: no empty blocks and no white space at the end of a body."""
    c = table(spark, sf_dir, "conversations").withColumn("text", F.when(F.col("turn") >= 3, "  ").otherwise(F.concat("text", F.lit(" \xa0"))))
    a = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("blocks"))
    return a.select("conv_id", F.posexplode(B.trim_trailing(F.col("blocks"))).alias("ix", "b")).select("conv_id", "ix", "b.text")


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS occurrence FROM conversations")
def occurrence_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-05: the how-manieth of its name."""
    return B.occurrence(table(spark, sf_dir, "conversations"), ["conv_id", "role"], "turn").select("conv_id", "turn", "occurrence")


@query("SELECT conv_id, coalesce(min(turn) FILTER (turn >= conv_id % 4), max(turn) + 1) AS prefix FROM conversations GROUP BY 1")
def common_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-09: how many blocks at the beginning agree."""
    c = table(spark, sf_dir, "conversations")
    other = c.withColumn("text", F.when(F.col("turn") >= F.col("conv_id") % 4, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    return B.common_prefix(c, other, "conv_id", "turn", "text")


@query("SELECT l_orderkey % 100 AS k, l_orderkey // 5000 AS batch, count(*) AS n FROM lineitem GROUP BY 1, 2")
def block_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-08, ARR-04: blocks in batches of a size."""
    l = B.batches(table(spark, sf_dir, "lineitem"), "l_orderkey", 5000)
    return l.groupBy((F.col("l_orderkey") % 100).alias("k"), "batch").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH i AS (SELECT o_custkey AS k, o_orderkey AS pos, o_orderpriority AS name, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) AS ni FROM orders WHERE o_orderkey % 2 = 0),
f AS (SELECT o_custkey AS k, o_orderkey AS pos, o_orderpriority AS name, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) AS nf FROM orders WHERE o_orderkey % 2 = 1)
SELECT i.k, i.pos, i.name, coalesce('f' || f.pos, 'i' || i.pos) AS url FROM i LEFT JOIN f ON f.k = i.k AND f.name = i.name AND ((f.nf = 1 AND f.n = 1) OR (f.nf > 1 AND f.nf = i.ni AND f.n = i.n))
""")
def body_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-05: images take the address of the file of their name."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("pos"), F.col("o_orderpriority").alias("name"))
    images = o.where("pos % 2 = 0").withColumn("url", F.concat(F.lit("i"), "pos"))
    return B.replace_media(images, o.where("pos % 2 = 1").withColumn("url", F.concat(F.lit("f"), "pos")), "k")


@query("SELECT c_custkey, string_agg(v, ',' ORDER BY n) AS files FROM (SELECT c_custkey, n, 'f' || n AS v FROM customer, (SELECT unnest([10, 2, 1]) AS n) WHERE NOT (n = 2 AND c_custkey % 2 = 0)) GROUP BY 1")
def numbered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ARR-05: values of numbered keys in the order of the numbers."""
    m = F.from_json(F.concat(F.lit('{"fileValue10":"f10","fileValue2":"'), F.when(F.col("c_custkey") % 2 == 0, "").otherwise("f2"), F.lit('","fileValue1":"f1","x":"y"}')), "map<string,string>")
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(B.numbered_values(m, "fileValue"), ",").alias("files"))


@query("SELECT n_regionkey AS region, count(*) AS rows, max(len) AS width, count(*) * max(len) AS cells FROM (SELECT n_regionkey, n_nationkey % 4 + 1 AS len FROM nation) GROUP BY 1")
def table_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ARR-03: rows of a table padded to one width."""
    n = table(spark, sf_dir, "nation")
    rows = n.groupBy(F.col("n_regionkey").alias("region")).agg(F.collect_list(F.array_repeat(F.lit("x"), F.col("n_nationkey") % 4 + 1)).alias("r")).withColumn("r", B.rectangular(F.col("r")))
    return rows.select("region", F.size("r").cast("bigint").alias("rows"), F.array_max(F.transform("r", F.size)).alias("width"), F.aggregate("r", F.lit(0).cast("bigint"), lambda a, x: a + F.size(x)).alias("cells"))

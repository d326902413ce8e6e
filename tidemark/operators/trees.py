"""Nested blocks: descent through containers of any depth, signatures of whole subtrees, and live media held against stored.

blocks(id, parent, pos): a null parent is a root. Descent is a recursive query, one join a level; what is nested deeper than
`depth` levels is not silently left out: `cut_off` tells it, and so it does blocks that hang on a cycle or on no block at
all, which no descent from a root reaches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage import cut

DEPTH = 50
PART = 1_024  # children that are hashed together


def descend(blocks: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Every block that a root reaches in at most `depth` steps: id, root, depth, container (its parent)."""
    spark, view = blocks.sparkSession, f"blocks_{uuid.uuid4().hex}"
    blocks.select("id", "parent").createOrReplaceTempView(view)
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # the rows are those of the table; levels are bounded
    return spark.sql(f"""
        WITH RECURSIVE below(id, root, depth, container) MAX RECURSION LEVEL {depth + 2} AS (
          SELECT id, id, 0, parent FROM {view} WHERE parent IS NULL
          UNION ALL SELECT b.id, d.root, d.depth + 1, b.parent FROM below d JOIN {view} b ON b.parent = d.id WHERE d.depth < {depth})
        SELECT id, root, depth, container FROM below""")


def cut_off(blocks: DataFrame, reached: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Blocks that the descent has not reached, with why: `orphan` (its parent is no block), `too_deep` (right below the
    last level), or `unreached` (on a cycle, or below any of these)."""
    rest = blocks.select("id", "parent").join(reached.select("id"), "id", "left_anti")
    ids = blocks.select(F.col("id").alias("parent"), F.lit(True).alias("there"))
    last = reached.where(F.col("depth") == depth).select(F.col("id").alias("parent"), F.lit(True).alias("at_last"))
    rest = rest.join(ids, "parent", "left").join(last, "parent", "left")
    return rest.select("id", "parent", F.when(F.col("there").isNull(), "orphan").when(F.col("at_last"), "too_deep").otherwise("unreached").alias("why"))


def signatures(blocks: DataFrame, own: Column, reached: DataFrame | None = None, depth: int = DEPTH) -> DataFrame:
    """id, signature: a hash of a block and all below it, in order. `own` is what is hashed of the block itself. From the
    lowest level up, one aggregate a level; children are hashed by parts of `PART`, so that no group grows with a parent."""
    reached = descend(blocks, depth) if reached is None else reached
    x = blocks.withColumn("own", F.sha2(own.cast("string"), 256)).join(reached.select("id", "depth"), "id").select("id", "parent", "pos", "own", "depth")
    x = cut(x)
    levels = x.agg(F.max("depth")).first()[0]
    if levels is None:
        return blocks.select("id", F.lit("").alias("signature")).limit(0)
    done, below = None, None
    for level in range(levels, -1, -1):
        here = x.where(F.col("depth") == level)
        if below is None:
            signed = here.withColumn("children", F.lit(""))
        else:
            some = below.groupBy("parent", F.floor(F.col("pos") / PART).alias("part")).agg(F.array_sort(F.collect_list(F.struct("pos", "id", "signature"))).alias("c"))
            some = some.select("parent", "part", F.sha2(F.array_join(F.transform("c", lambda y: y["signature"]), ","), 256).alias("hash"))
            all_parts = some.groupBy(F.col("parent").alias("id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "hash"))), lambda y: y["hash"]), ",").alias("children"))
            signed = here.join(all_parts, "id", "left").withColumn("children", F.coalesce("children", F.lit("")))
        signed = cut(signed.select("id", "parent", "pos", F.sha2(F.concat("own", F.lit(":"), "children"), 256).alias("signature")))
        done = signed if done is None else done.unionByName(signed)
        below = signed
    return done.select("id", "signature")


def held_media(reached: DataFrame, live: DataFrame, stored: DataFrame) -> DataFrame:
    """JON-07 at any depth. live(id, kind, key): media blocks; stored(root, id, kind, key): what is on record for a root. Of
    every root with either: `valid`, `drift` (another number, a block that is not there or is of another kind or key), or
    `unavailable` (a key is missing, or stands twice), whichever comes first in this order of looking: counts, keys, blocks."""
    there = live.join(reached.select("id", "root"), "id")
    keys = stored.groupBy("root").agg(F.count(F.lit(1)).alias("n_stored"), F.count_if(F.col("key").isNull()).alias("no_key"), F.count_distinct("key").alias("n_keys"))
    counts = there.groupBy("root").agg(F.count(F.lit(1)).alias("n_live"))
    met = stored.alias("s").join(there.alias("l"), (F.col("s.root") == F.col("l.root")) & (F.col("s.id") == F.col("l.id")), "left")
    wrong = met.where(F.col("l.id").isNull() | ~F.col("s.kind").eqNullSafe(F.col("l.kind")) | ~F.col("s.key").eqNullSafe(F.col("l.key"))).groupBy(F.col("s.root").alias("root")).agg(F.count(F.lit(1)).alias("wrong"))
    x = counts.join(keys, "root", "full").join(wrong, "root", "left").fillna(0, ["n_live", "n_stored", "no_key", "n_keys", "wrong"])
    status = F.when(F.col("n_live") != F.col("n_stored"), "drift").when((F.col("no_key") > 0) | (F.col("n_keys") < F.col("n_stored")), "unavailable").when(F.col("wrong") > 0, "drift").otherwise("valid")
    return x.select("root", "n_live", "n_stored", status.alias("status"))


def conflict_groups(edges: DataFrame) -> DataFrame:
    """JON-02. edges(item, row): which destination rows an item's lookups have found. A row may serve one item only, and an
    item have one row. Wherever that fails, the items and rows that hang together are one conflict: side (`item` or `row`),
    id, conflict (its least item). Labels pass to and fro over the edges of conflicts alone until none falls."""
    edges = edges.select("item", "row").distinct()
    many = lambda c: edges.groupBy(c).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(c)
    rows, items = many("row"), many("item")
    seeds = edges.join(rows, "row", "left_semi").unionByName(edges.join(items, "item", "left_semi").select("row", "item")).distinct()
    # what an edge in conflict touches is in it as well
    own = edges.join(seeds.select("row").distinct(), "row", "left_semi").select("item", "row").union(edges.join(seeds.select("item").distinct(), "item", "left_semi").select("item", "row")).distinct()
    own = cut(own)
    labels, before = own.groupBy("item").agg(F.min("item").alias("label")), None
    while True:
        by_row = own.join(labels, "item").groupBy("row").agg(F.min("label").alias("label"))
        labels = cut(own.join(by_row, "row").groupBy("item").agg(F.min("label").alias("label")))
        total = labels.agg(F.sum(F.xxhash64("item", "label").cast("decimal(38,0)"))).first()[0]
        if total == before:
            break
        before = total
    by_row = own.join(labels, "item").groupBy("row").agg(F.min("label").alias("label"))
    return labels.select(F.lit("item").alias("side"), F.col("item").alias("id"), F.col("label").alias("conflict")).unionByName(by_row.select(F.lit("row").alias("side"), F.col("row").alias("id"), F.col("label").alias("conflict")))

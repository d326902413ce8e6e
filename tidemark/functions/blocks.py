"""Ordered content blocks: arrays of structs or rows with an explicit place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import WS


def trim_trailing(blocks: Column, text: str = "text") -> Column:
    """Without the empty blocks at the end, and without white space at the end of the last one left."""
    blank = lambda b: F.coalesce(b[text], F.lit("")).rlike(rf"\A{WS}*\z")
    last = F.coalesce(F.array_max(F.transform(blocks, lambda b, i: F.when(~blank(b), i + 1))), F.lit(0))
    kept = F.slice(blocks, F.lit(1), last)
    return F.transform(kept, lambda b, i: F.when(i == last - 1, b.withField(text, F.regexp_replace(b[text], rf"{WS}+\z", ""))).otherwise(b))


def body_hash(rows: DataFrame, key: str, order: str, fields: list[str]) -> DataFrame:
    """One row per key: a hash over the fields of its blocks in order; null differs from empty."""
    one = F.concat_ws("\x1f", *(F.coalesce(F.concat(F.lit("="), F.col(f).cast("string")), F.lit("-")) for f in fields))
    a = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), one.alias("x"))))
    return rows.groupBy(key).agg(a.alias("a")).select(key, F.sha2(F.array_join(F.transform("a", lambda x: x.x), "\x1e"), 256).alias("body_hash"), F.size("a").alias("n_blocks"))


def occurrence(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """How many times the keys have come up to each row."""
    return rows.withColumn("occurrence", F.row_number().over(Window.partitionBy(*keys).orderBy(order)).cast("bigint"))


def common_prefix(a: DataFrame, b: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """For each key of a: how many blocks at the beginning are the same in b. Places are dense from 0."""
    x = a.select(key, order, F.col(value).alias("va")).join(b.select(key, order, F.col(value).alias("vb"), F.lit(True).alias("there")), [key, order], "left")
    differs = F.col("there").isNull() | ~F.col("va").eqNullSafe(F.col("vb"))
    return x.groupBy(key).agg(F.coalesce(F.min(F.when(differs, F.col(order))), F.max(order) + 1).alias("prefix"))


def batches(rows: DataFrame, order: str, size: int = 50) -> DataFrame:
    return rows.withColumn("batch", F.floor(F.col(order) / size))


def rectangular(rows: Column, rows_most: int = 200, columns_most: int = 100, cells_most: int = 5_000) -> Column:
    """Rows of cells padded to the longest; null beyond the limits."""
    width = F.array_max(F.transform(rows, F.size))
    fits = (F.size(rows) <= rows_most) & (width <= columns_most) & (F.size(rows) * width <= cells_most)
    return F.when(fits, F.transform(rows, lambda r: F.concat(r, F.array_repeat(F.lit(""), width - F.size(r)))))


def numbered_values(fields: Column, prefix: str, most: int = 100) -> Column:
    """Values of a map under keys `<prefix>N`, in the order of N."""
    n = lambda k: F.regexp_extract(k, rf"^{prefix}(\d+)$", 1).try_cast("int")
    kept = F.map_filter(fields, lambda k, v: n(k).between(1, most) & (F.coalesce(v, F.lit("")) != ""))
    return F.transform(F.array_sort(F.transform(F.map_entries(kept), lambda e: F.struct(n(e.key).alias("n"), e.value.alias("v")))), lambda e: e.v)


def replace_media(images: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """images(key, pos, name, url) joined to files(key, pos, name, url) by name: the n-th of a name takes the n-th file of
    it, or the only one there is; a name whose counts do not agree keeps its urls."""
    nth = lambda x: occurrence(x, [key, "name"], "pos")
    count = lambda x, c: x.groupBy(key, "name").agg(F.count(F.lit(1)).alias(c))
    f = nth(files).select(key, "name", "occurrence", F.col("url").alias("file_url"))
    x = nth(images).join(count(images, "n_images"), [key, "name"]).join(count(files, "n_files"), [key, "name"], "left")
    x = x.withColumn("want", F.when(F.col("n_files") == 1, F.lit(1).cast("bigint")).when(F.col("n_files") == F.col("n_images"), F.col("occurrence")))
    out = x.join(f.withColumnRenamed("occurrence", "want"), [key, "name", "want"], "left")
    return out.select(key, "pos", "name", F.coalesce("file_url", "url").alias("url"))

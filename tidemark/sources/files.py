"""Captured inputs: JSON pages, HTML files, settings text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = "source string, page int, pageSize int, total bigint, hasNextPage string, isLastPage string, list array<string>"


def captured_pages(spark: SparkSession, path: str) -> DataFrame:
    """List pages stored as JSON, a row per list row, with `error` set on a page that breaks the contract: no list, more
    rows than its size, or flags that contradict each other."""
    p = spark.read.schema(PAGE).option("mode", "PERMISSIVE").json(path)
    yes = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit("")))).isin("true", "1", "yes", "y")
    error = F.when(F.col("list").isNull(), "no_list").when(F.size("list") > F.col("pageSize"), "page_size").when(F.col("isLastPage").isNotNull() & (yes("hasNextPage") == yes("isLastPage")), "flags")
    rows = p.select("source", F.col("page").alias("page_no"), "total", yes("hasNextPage").alias("has_more"), error.alias("error"), F.posexplode_outer("list").alias("pos", "raw"))
    return rows


def html_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("url"), F.col("value").alias("html"))


def binary_files(spark: SparkSession, path: str) -> DataFrame:
    """Files with their bytes and SHA-256."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "content", F.sha2("content", 256).alias("sha256"))


def settings(text: str) -> dict[str, str]:
    """`KEY=VALUE` lines; comments, an `export` before the key and quotes around the value are dropped, the last wins."""
    out = {}
    for line in text.splitlines():
        key, sign, value = line.strip().removeprefix("export ").partition("=")
        if sign and not key.startswith("#") and key.strip():
            value = value.strip()
            out[key.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return out


def value_map(text: str) -> dict[str, str]:
    """`k:v;k=v` maps, parted by semicolons, commas or lines; the last of equal keys wins."""
    out = {}
    for part in text.replace(",", ";").replace("\n", ";").split(";"):
        cut = min((i for i in (part.find(":"), part.find("=")) if i >= 0), default=-1)
        if cut > 0 and part[cut + 1 :].strip():
            out[part[:cut].strip()] = part[cut + 1 :].strip()
    return out

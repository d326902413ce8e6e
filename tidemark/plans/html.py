"""Queries over HTML pages. Their parsing has no SQL form, but for the title, which these pages hold in an h1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.text import strip
from .registry import query, table


@query("SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1, 's'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&'), '\\s+', ' ', 'g')) AS title FROM pages")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTM-08: the title of a page; none of a page that is null."""
    return table(spark, sf_dir, "pages").select("page_id", F.when(F.col("html").isNotNull(), H.detail_title(F.col("html"))).alias("title"))


@query()
def html_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTM-03, FLT-15: what a reader sees, and whether it tells of an error."""
    x = table(spark, sf_dir, "pages").select("page_id", H.visible_text(F.col("html")).alias("text"))
    return x.withColumn("error", F.lower("text").rlike("not found|access denied|service unavailable"))


@query()
def html_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTM-05, HTM-06, HTM-09, HTM-10: what a page shows of its parts."""
    return table(spark, sf_dir, "pages").select("page_id", H.page_signals(F.col("html")).alias("s")).select("page_id", "s.*")


@query()
def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTM-02: a body as ordered blocks."""
    x = table(spark, sf_dir, "pages").select("page_id", F.explode(H.body_blocks(F.col("html"))).alias("b"))
    return x.select("page_id", "b.block_ix", "b.type", "b.text", "b.url", F.size("b.segments").alias("n_segments"))


@query()
def html_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTM-01, SRC-07: rows of list tables; the pages' list items are put into a table first, since they have none."""
    page = F.regexp_replace(F.regexp_replace("html", "<li>", "<tr><td>1</td><td>"), "</li>", "</td><td>2024-01-02</td><td>x</td><td>3</td></tr>")
    x = table(spark, sf_dir, "pages").select("page_id", F.explode(H.table_rows(page)).alias("r")).where(F.size("r.cells") >= 5)
    return x.select("page_id", "r.row_ix", strip(F.element_at("r.cells", 2)).alias("title"), "r.href", "r.pinned")


@query()
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTM-04: links of a page's blocks, each once, by first place."""
    x = table(spark, sf_dir, "pages").select("page_id", F.explode(H.body_blocks(F.col("html"), False)).alias("b"))
    x = x.select("page_id", "b.block_ix", F.explode("b.segments").alias("s")).where("s.link IS NOT NULL")
    return x.groupBy("page_id", F.col("s.link").alias("url")).agg(F.min("block_ix").alias("block_ix"), F.min_by("s.text", "block_ix").alias("name"))


@query("""
WITH p AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN replace(url, '?', '?z=9&a=b%20c&a=b&') ELSE url END AS u FROM pages), q AS (SELECT page_id, regexp_replace(u, '#.*$', '') AS u FROM p),
s AS (SELECT page_id, 'https://' || lower(regexp_extract(u, '^https?://([^/?#]*)', 1)) || regexp_extract(u, '^https?://[^/?#]*([^?#]*)', 1) AS base, list_sort(list_filter(string_split(replace(regexp_extract(u, '[?](.*)$', 1), '%20', '+'), '&'), lambda x: x <> '' AND split_part(x, '=', 1) NOT IN ('page', 'ref', 'utm_source', 'utm_medium', 'utm_campaign'))) AS kept FROM q)
SELECT page_id, base || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS url FROM s
""")
def canonical_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL-01, URL-02: one form of an address: https, lower host, sorted query without tracking keys, no fragment."""
    from ..functions.urls import canonical

    url = F.when(F.col("page_id") % 2 == 0, F.replace("url", F.lit("?"), F.lit("?z=9&a=b%20c&a=b&"))).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", canonical(url).alias("url"))

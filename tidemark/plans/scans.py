"""Queries of the scan rules. Roles: line items are list rows (an order is a page), events are scan observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import scans as S
from .registry import query, table


def list_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source: one of ten suppliers' groups; a page is an order; the id of a row is its part."""
    l = table(spark, sf_dir, "lineitem")
    return l.select((F.col("l_orderkey") % 10).alias("source"), F.col("l_orderkey").alias("page_no"), F.col("l_linenumber").cast("bigint").alias("pos"), F.col("l_partkey").alias("item_id"), (F.col("l_returnflag") == "R").alias("pinned"), "l_quantity")


ROWS = "r AS (SELECT l_orderkey % 10 AS source, l_orderkey AS page_no, CAST(l_linenumber AS BIGINT) AS pos, l_partkey AS item_id, l_returnflag = 'R' AS pinned, l_quantity FROM lineitem)"


@query(f"""
WITH {ROWS}, s AS (SELECT source, count(*) AS n_rows, count(DISTINCT CASE WHEN NOT pinned THEN item_id END) AS n_ids FROM r GROUP BY 1)
SELECT source, n_rows, n_ids, total, total = n_rows OR total = n_ids AS satisfied FROM (SELECT *, CASE WHEN source % 2 = 0 THEN n_rows ELSE n_rows + 1 END AS total FROM s)
""")
def page_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-03: the declared total against what was seen."""
    r = list_rows(spark, sf_dir)
    declared = r.groupBy("source").agg(F.count(F.lit(1)).alias("n")).select("source", F.when(F.col("source") % 2 == 0, F.col("n")).otherwise(F.col("n") + 1).alias("total"))
    return S.totals_satisfied(r, "source", "item_id", "pinned", declared)


@query(f"""
WITH {ROWS}, p AS (SELECT source, page_no, string_agg(CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR), ',' ORDER BY pos, CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR)) AS sig FROM r GROUP BY 1, 2),
f AS (SELECT source, sig, min(page_no) AS first_page FROM p GROUP BY 1, 2)
SELECT p.source, p.page_no, f.first_page FROM p JOIN f USING (source, sig) WHERE p.page_no > f.first_page
""")
def repeated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED-02: a page that repeats an earlier one of its source is an error."""
    r = list_rows(spark, sf_dir).withColumn("q", F.col("l_quantity").cast("bigint"))
    signed = S.page_signatures(r, ["source", "page_no"], ["q"], "pos")
    return S.repeated_pages(signed, "source", "page_no").select("source", "page_no", "first_page")


@query("""
SELECT doc_id, sha256(coalesce(text, '')) = sha256(CASE WHEN doc_id % 13 = 0 THEN coalesce(text, '') || '.' ELSE coalesce(text, '') END) AS stable FROM documents
""")
def snapshot_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED-02, DED-03: two readings of a detail must hash alike."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    first = d.select("doc_id", F.sha2("text", 256).alias("a"))
    second = d.select("doc_id", F.sha2(F.when(F.col("doc_id") % 13 == 0, F.concat("text", F.lit("."))).otherwise(F.col("text")), 256).alias("b"))
    return first.join(second, "doc_id").select("doc_id", (F.col("a") == F.col("b")).alias("stable"))


@query(f"""
WITH {ROWS}, u AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY page_no, pos) AS nth FROM r WHERE NOT pinned AND item_id % 3 = 0)
SELECT source, count(*) AS unknown, min(CASE WHEN nth > 20 THEN page_no END) AS resume_page, CAST(sum(CASE WHEN nth <= 20 THEN item_id END) AS BIGINT) AS read_ids FROM u GROUP BY 1
""")
def backfill_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-01: the first twenty unknown rows of a source are read; the page of the next one is where to resume."""
    r = list_rows(spark, sf_dir).where("NOT pinned")
    w = S.backfill_window(r, r.where("item_id % 3 <> 0"), "source", "item_id", ["page_no", "pos"])
    many = r.where("item_id % 3 = 0").groupBy("source").agg(F.count(F.lit(1)).alias("unknown"))
    return many.join(w.groupBy("source").agg(F.min(F.when(~F.col("read"), F.col("page_no"))).alias("resume_page"), F.sum(F.when(F.col("read"), F.col("item_id"))).alias("read_ids")), "source")


@query(f"""
WITH {ROWS}, p AS (SELECT source, page_no, count(*) FILTER (item_id % 7 <> 0) AS known, count(*) FILTER (item_id % 7 = 0) AS unknown FROM r GROUP BY 1, 2),
g AS (SELECT *, sum(CASE WHEN known > 0 AND unknown = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY source ORDER BY page_no) AS run FROM p)
SELECT source, page_no, CAST(sum(CASE WHEN known > 0 AND unknown = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY source, run ORDER BY page_no) AS BIGINT) AS overlap FROM g
""")
def checkpoint_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-02: pages in a row that hold known rows only."""
    r = list_rows(spark, sf_dir)
    p = r.groupBy("source", "page_no").agg(F.count_if(F.col("item_id") % 7 != 0).alias("known"), F.count_if(F.col("item_id") % 7 == 0).alias("unknown"))
    return S.checkpoint_overlap(p, "source", "page_no").select("source", "page_no", "overlap")


@query(f"""
WITH {ROWS}, p AS (SELECT DISTINCT source, item_id, (page_no * 100 + pos) * 2 + CAST(pinned AS BIGINT) AS place, pinned FROM r), w AS (SELECT *, row_number() OVER v AS nth, pinned IS NOT DISTINCT FROM lag(pinned) OVER v AS allowed FROM p WINDOW v AS (PARTITION BY source, item_id ORDER BY place))
SELECT source, item_id, place, pinned, allowed FROM w WHERE nth > 1
""")
def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-05 rule 5: an id may come again only as the same row."""
    r = list_rows(spark, sf_dir).select("source", "item_id", ((F.col("page_no") * 100 + F.col("pos")) * 2 + F.col("pinned").cast("bigint")).alias("place"), "pinned").distinct()
    return S.duplicate_ids(r, "source", "item_id", "place", ["pinned"])


@query("""
WITH m AS (SELECT user_id AS source, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS priority, bool_and(value > 1) AS write_safe FROM events GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY write_safe DESC, priority) AS rn FROM m)
SELECT source, write_safe, priority FROM k WHERE rn = 1
""")
def source_priority_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10, SRC-11: of several results of a source, a safe one first, then by the order of the methods."""
    e = table(spark, sf_dir, "events")
    priority = F.when(F.col("event_type") == "view", 1).when(F.col("event_type") == "click", 2).otherwise(3)
    m = e.groupBy(F.col("user_id").alias("source"), priority.alias("priority")).agg(F.bool_and(F.col("value") > 1).alias("write_safe"))
    return S.best_source_result(m, "source", "write_safe", "priority")


@query("""
SELECT source, min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang, sha256(coalesce(text, '')) AS body_hash FROM documents GROUP BY source, sha256(coalesce(text, ''))
""")
def first_seen_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED-01: the first of equal items stays."""
    d = table(spark, sf_dir, "documents").select("source", "doc_id", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("body_hash"))
    return S.first_seen(d, ["source", "body_hash"], "doc_id")


@query("""
SELECT event_id, coalesce(json_extract_string(props, '$.pageNum'), json_extract_string(props, '$.page'), json_extract_string(props, '$.k')) AS page,
  try_cast(json_extract_string(props, '$.k') AS BIGINT) AS total, lower(trim(coalesce(json_extract_string(props, '$.flag'), ''))) IN ('true', '1', 'yes', 'y') AS has_more FROM events
""")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSN-01, SRC-02: a page field under several names, with lenient numbers and flags."""
    get = lambda k: F.get_json_object("props", f"$.{k}")
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(get("pageNum"), get("page"), get("k")).alias("page"), get("k").try_cast("bigint").alias("total"), F.lower(F.trim(F.coalesce(get("flag"), F.lit("")))).isin("true", "1", "yes", "y").alias("has_more"))


@query("""
WITH x AS (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 9 = 1 THEN '' ELSE c_name END AS title, CASE c_custkey % 5 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN 'x' ELSE 'N' END AS top, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS id FROM customer)
SELECT c_custkey, CASE WHEN id IS NULL THEN 'id_type' WHEN NOT regexp_full_match(id, '[0-9]{1,32}') THEN 'id_value' WHEN title IS NULL THEN 'title_type' WHEN top NOT IN ('Y', 'N') THEN 'top_enum' END AS failing FROM x
""")
def list_entry_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-01: the first field of a list row that breaks the contract."""
    k = F.col("c_custkey")
    title = F.when(k % 9 == 0, F.lit(None)).when(k % 9 == 1, "").otherwise(F.col("c_name"))
    top = F.when(k % 5 == 0, "Y").when(k % 5 == 1, "N").when(k % 5 == 2, "x").otherwise("N")
    key = F.when(k % 11 != 0, k.cast("string"))
    failing = F.when(key.isNull(), "id_type").when(~key.rlike("^[0-9]{1,32}$"), "id_value").when(title.isNull(), "title_type").when(~top.isin("Y", "N"), "top_enum")
    return table(spark, sf_dir, "customer").select("c_custkey", failing.alias("failing"))

"""Queries of point lookups, destination scans and block predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.urls import official
from ..functions.values import fingerprint
from ..operators import scans as S
from ..operators.reports import follows
from .registry import query, table


@query("SELECT o_orderkey, c_name, c_custkey IS NULL AS missing FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 10 <> 0")
def detail_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-04: the detail of every list row, or that there is none."""
    c = table(spark, sf_dir, "customer").where("c_custkey % 10 <> 0").select("c_custkey", "c_name")
    return table(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_name", F.col("c_custkey").isNull().alias("missing"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, o_orderkey IS NOT NULL AS found, coalesce(l_linestatus = o_orderstatus AND year(l_shipdate) = year(o_orderdate), false) AS agrees FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
""")
def fallback_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-06, FLT-12: in a fallback scan, title and date of the detail must equal those of the list row. Line items are list
    rows, orders details; a status is a title, a year a date."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_linestatus").alias("title"), F.year("l_shipdate").alias("date"))
    details = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("title"), F.year("o_orderdate").alias("date"))
    return S.details_agree(rows, details, ["l_orderkey"], ["title", "date"]).drop("title", "date")


@query("SELECT n_name AS source, r_name AS classification, n_nationkey % 2 = 0 AS required FROM nation JOIN region ON n_regionkey = r_regionkey")
def source_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-13, SRC-12: sources with their classification; a source without one is an error."""
    r = table(spark, sf_dir, "region")
    x = table(spark, sf_dir, "nation").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    known = F.when(F.col("r_name").isNull(), F.raise_error(F.concat(F.lit("no classification for "), "n_name")).cast("string")).otherwise(F.col("r_name"))
    return x.select(F.col("n_name").alias("source"), known.alias("classification"), (F.col("n_nationkey") % 2 == 0).alias("required"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' AND o_totalprice > 100000")
def destination_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-16, SRC-15: a filtered scan, whose filters reach the files."""
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' AND o_totalprice > 100000").select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, l_linenumber, l_partkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey")
def child_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-17: the children of destination rows, and rows that have none."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return o.join(l, o.o_orderkey == l.l_orderkey, "left").select("o_orderkey", "l_linenumber", "l_partkey")


@query("SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_ids, count(*) = count(DISTINCT o_orderkey) AS whole FROM orders")
def full_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-18, AGG-09: a full scan must hold every id once."""
    x = table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_orderkey").alias("n_ids"))
    return x.withColumn("whole", F.col("n_rows") == F.col("n_ids"))


@query("SELECT event_id, event_type || ' ' || coalesce(json_extract_string(props, '$.k'), '') AS title, event_type AS kind, user_id AS item FROM events")
def typed_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-12, PRJ-13: values out of typed properties."""
    parts = F.array(F.struct(F.col("event_type").alias("plain_text")), F.struct(F.lit(" ").alias("plain_text")), F.struct(F.coalesce(F.get_json_object("props", "$.k"), F.lit("")).alias("plain_text")))
    props = F.struct(parts.alias("title"), F.struct(F.col("event_type").alias("name")).alias("select"), F.col("user_id").alias("number"))
    x = table(spark, sf_dir, "events").select("event_id", props.alias("p"))
    return x.select("event_id", F.array_join(F.transform("p.title", lambda t: t.plain_text), "").alias("title"), F.col("p.select.name").alias("kind"), F.col("p.number").alias("item"))


@query("""
SELECT page_id, CASE WHEN regexp_full_match(url, 'https://[^/]+/[a-z]+/[0-9]+') THEN split_part(url, '/', 4) END AS source, CASE WHEN regexp_full_match(url, 'https://[^/]+/[a-z]+/[0-9]+') THEN split_part(url, '/', 5) END AS item FROM pages
""")
def official_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-14: source and id of an address in exactly the official form, which here is `https://host/source/id`."""
    found = official(F.col("url"), r"https://[^/]+/([a-z]+)/(\d+)")
    return table(spark, sf_dir, "pages").select("page_id", found.alias("f")).select("page_id", "f.source", "f.item")


@query("SELECT conv_id, turn, CASE WHEN turn % 4 = 3 THEN 'image' ELSE 'heading_' || CAST(least(3, turn % 4 + 2) AS VARCHAR) END AS type, CASE WHEN turn % 4 = 3 THEN 'https://h/' || conv_id END AS url FROM conversations")
def built_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-17, PRJ-18: blocks made from values, heading levels held at three."""
    k = F.col("turn") % 4
    image = F.struct(F.lit("image").alias("type"), F.concat(F.lit("https://h/"), "conv_id").alias("url"))
    heading = F.struct(F.concat(F.lit("heading_"), F.least(F.lit(3), k + 2)).alias("type"), F.lit(None).cast("string").alias("url"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(k == 3, image).otherwise(heading).alias("b")).select("conv_id", "turn", "b.*")


@query("SELECT conv_id, bool_or(role = 'assistant') AS has_answer, bool_and(role IN ('user', 'assistant')) AS known_kinds, coalesce(min(text) FILTER (turn = 99), '') AS body FROM conversations GROUP BY 1")
def block_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ARR-06, ARR-07, FLT-11: whether a block is there, all are of known kinds, and what stands in for an empty body."""
    a = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", "text")).alias("b"))
    body = F.try_element_at(F.filter("b", lambda x: x.turn == 99), F.lit(1)).text
    return a.select("conv_id", F.exists("b", lambda x: x.role == "assistant").alias("has_answer"), F.forall("b", lambda x: x.role.isin("user", "assistant")).alias("known_kinds"), F.coalesce(body, F.lit("")).alias("body"))


@query("SELECT page_id, page_id % 4 = 0 AS web, page_id % 4 = 1 AS mail, page_id % 4 = 2 AS file FROM pages")
def url_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-09: kinds of addresses that a destination takes."""
    k = F.col("page_id") % 4
    u = F.when(k == 0, F.col("url")).when(k == 1, "mailto:a@b.c").when(k == 2, "https://files.example/x.PDF").otherwise("javascript:void(0)")
    ok = F.try_parse_url(u, F.lit("HOST"))
    file = u.rlike(r"(?i)^https://[^/]+/.*\.(pdf|docx?|xlsx?|pptx?|hwpx?|zip)$")
    return table(spark, sf_dir, "pages").select("page_id", (u.rlike("^https?://") & ok.isNotNull() & ~file).alias("web"), u.rlike("^mailto:[^@\\s]+@[^@\\s]+$").alias("mail"), file.alias("file"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN n_chars END AS attachments, doc_id % 3 <> 0 AS present, doc_id % 7 <> 0 AS id_ok FROM documents")
def unknown_attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-22: what is not known is left out of a write, not nulled; ids must be of digits."""
    k = F.col("doc_id")
    known = k % 3 != 0
    key = F.when(k % 7 == 0, F.concat(k, F.lit("x"))).otherwise(k.cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", F.when(known, F.col("n_chars")).alias("attachments"), known.alias("present"), key.rlike("^[0-9]{1,32}$").alias("id_ok"))


@query("""
WITH r AS (SELECT DISTINCT user_id AS source, date_diff('day', TIMESTAMP '2024-01-01', ts) AS run_no FROM events), l AS (SELECT *, CASE WHEN run_no % 5 = 4 THEN run_no - 1 ELSE run_no END AS logical FROM r),
w AS (SELECT *, lag(run_no) OVER v AS run_before, lag(logical) OVER v AS logical_before FROM l WINDOW v AS (PARTITION BY source ORDER BY run_no))
SELECT source, run_no, coalesce(run_before = run_no - 1 AND logical_before <> logical, false) AS follows FROM w
""")
def distinct_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-02: an observation counts on only if it is of the run before and of another logical run. Days are runs, every fifth
    a second attempt of the one before."""
    r = table(spark, sf_dir, "events").select(F.col("user_id").alias("source"), F.datediff(F.to_date("ts"), F.lit("2024-01-01")).cast("bigint").alias("run_no")).distinct()
    r = r.withColumn("logical", F.when(F.col("run_no") % 5 == 4, F.col("run_no") - 1).otherwise(F.col("run_no")).cast("string"))
    w = Window.partitionBy("source").orderBy("run_no")
    return r.select("source", "run_no", follows(F.col("run_no"), F.col("logical"), F.lag("run_no").over(w), F.lag("logical").over(w)).alias("follows"))


@query("SELECT page_id, 'https://h/%C3%A9%20' || page_id AS link FROM pages")
def link_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL-04: one percent-encoding of a link, whatever it came in."""
    k = F.col("page_id")
    raw = F.when(k % 2 == 0, F.concat(F.lit("é "), k)).otherwise(F.concat(F.lit("%c3%a9%20"), k))
    path = F.replace(F.url_encode(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))), F.lit("+"), F.lit("%20"))
    return table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("https://h/"), path).alias("link"))


@query("SELECT conv_id, sha256(string_agg('=' || CASE WHEN turn % 3 = 0 THEN 'media:' || sha256(text) ELSE text END, chr(30) ORDER BY turn)) AS media_hash FROM conversations GROUP BY 1")
def media_body_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HSH-02: media count by their content, so that an address that rotates does not change the body's hash."""
    from ..functions.blocks import body_hash

    value = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("media:"), F.sha2("text", 256))).otherwise(F.col("text"))
    x = table(spark, sf_dir, "conversations").withColumn("value", value)
    return body_hash(x, "conv_id", "turn", ["value"]).select("conv_id", F.col("body_hash").alias("media_hash"))


@query("SELECT p_partkey, sha256('=' || p_partkey || chr(0) || '=' || p_brand) AS row_hash FROM part")
def row_seal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-04, HSH-05: a hash for each row, from which a table's seal is made."""
    return table(spark, sf_dir, "part").select("p_partkey", fingerprint(F.col("p_partkey"), F.col("p_brand")).alias("row_hash"))

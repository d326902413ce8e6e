"""Queries of records, codecs and matches. Roles: documents and conversations are items, orders live destination rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import sinks
from ..functions.values import fingerprint
from ..operators import records as R
from .registry import query, table


@query("""
SELECT doc_id, left(source, 300) AS source, CASE WHEN doc_id % 3 <> 0 THEN n_chars END AS views, CASE WHEN doc_id % 4 <> 0 THEN lang END AS kind,
  concat_ws(',', CASE WHEN doc_id % 3 <> 0 THEN 'views' END, CASE WHEN doc_id % 4 <> 0 THEN 'kind' END) AS present FROM documents
""")
def destination_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-01, PRJ-02, PRJ-06: destination columns, with those told that an item does not have."""
    k = F.col("doc_id")
    return R.destination_row(table(spark, sf_dir, "documents"), {"doc_id": k, "source": F.left("source", F.lit(300))}, {"views": F.when(k % 3 != 0, F.col("n_chars")), "kind": F.when(k % 4 != 0, F.col("lang"))})


@query("""
SELECT doc_id, CASE WHEN quality IS NULL OR quality = 0 THEN 'incomplete' WHEN doc_id % 7 = 0 THEN 'no_title' WHEN doc_id % 11 = 0 THEN 'no_url' END AS reason
FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR quality = 0 OR doc_id % 7 = 0 OR doc_id % 11 = 0
""")
def rejected_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-05: items that a gate keeps back, and why."""
    k = F.col("doc_id")
    x = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return R.complete_items(x, F.col("quality") == 1, F.when(k % 7 == 0, " ").otherwise("t"), F.when(k % 11 != 0, "u"))[1].select("doc_id", "reason")


@query("SELECT conv_id AS source_ord, CAST(turn AS INT) AS item_ord, role AS item, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM conversations")
def flatten_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-03: the items of every source in order."""
    a = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("source_ord")).agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x.role).alias("items"))
    return R.flatten(a, "items")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def project_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-04: only listed keys of a map."""
    m = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("secret"), F.lit("x")))
    kept = R.allowed_keys(m, ("k", "other"))
    return table(spark, sf_dir, "events").select("event_id", F.try_element_at(kept, F.lit("k")).alias("k"))


@query("SELECT conv_id, CASE WHEN count(*) > 1 THEN max(turn) - 1 ELSE max(turn) END AS first_kept, CAST(least(2, count(*)) AS INT) AS n FROM conversations GROUP BY 1")
def last_runs_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-04: the last two of an array, however short."""
    a = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(R.last_two(F.array_sort(F.collect_list("turn"))).alias("a"))
    return a.select("conv_id", F.element_at("a", 1).alias("first_kept"), F.size("a").alias("n"))


@query("SELECT conv_id, turn, role FROM conversations")
def drop_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-07, DED-08: a field dropped from every struct of an array, and arrays compared without it."""
    c = table(spark, sf_dir, "conversations")
    a = c.select("conv_id", F.array(F.struct("turn", "role", F.col("text").alias("generation_id"))).alias("a"))
    bare = F.transform("a", lambda x: x.dropFields("generation_id"))
    return a.select("conv_id", F.explode(bare).alias("x")).select("conv_id", "x.*")


@query("""
SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'g' || doc_id END AS generation, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE CAST(doc_id % 3 + 1 AS INT) END AS part, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE sha256(coalesce(text, '')) END AS sha FROM documents
""")
def body_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-16, STA-10: the header of a body, written and read."""
    k = F.col("doc_id")
    m = R.marker(F.concat(F.lit("g"), k), k % 3 + 1, F.lit(3), F.sha2(F.coalesce("text", F.lit("")), 256))
    m = F.when(k % 5 == 0, F.regexp_replace(m, "SHA256", "SHA")).otherwise(m)
    return table(spark, sf_dir, "documents").select("doc_id", R.read_marker(m).alias("m")).select("doc_id", "m.generation", "m.part", "m.sha")


@query("""
WITH b AS (SELECT o_custkey AS k, o_orderstatus AS generation, o_orderkey % 4 AS part, 4 AS parts FROM orders), g AS (SELECT k, generation, count(*) AS n, count(DISTINCT part) AS d FROM b GROUP BY 1, 2)
SELECT k, generation, n, n = d AND n = 4 AS whole FROM g
""")
def generation_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-03: the parts of a generation, all there once or not."""
    o = table(spark, sf_dir, "orders")
    return R.whole_generations(o.select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("generation"), (F.col("o_orderkey") % 4).alias("part"), F.lit(4).alias("parts")), "k")


@query("""
SELECT o_custkey AS k, CASE WHEN o_custkey % 5 = 0 AND count(*) > 0 THEN 'drift' WHEN bool_or(o_orderkey % 97 = 0) THEN 'unavailable' WHEN bool_or(o_orderkey % 31 = 0) THEN 'drift' ELSE 'valid' END AS status FROM orders GROUP BY 1
""")
def media_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-07: stored media against live blocks, all or nothing."""
    o, i = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    stored = o.select(F.col("o_custkey").alias("k"), F.when(i % 97 != 0, i).alias("block_id"), F.col("o_orderstatus").alias("type"), F.col("o_orderpriority").alias("hosted_key"))
    live = o.select(F.col("o_custkey").alias("k"), i.alias("block_id"), F.col("o_orderstatus").alias("type"), F.when(i % 31 == 0, "x").otherwise(F.col("o_orderpriority")).alias("hosted_key"))
    more = live.where("k % 5 = 0").dropDuplicates(["k"]).withColumn("block_id", F.lit(-1).cast("bigint"))
    return R.match_media(stored, live.unionByName(more), "k")


@query("SELECT conv_id, turn AS pos, role AS name, text AS hosted_key FROM conversations WHERE conv_id % 3 <> 0")
def positional_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-06: two lists joined by place, only where all names agree."""
    c = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("pos"), F.col("role").alias("name"), F.col("text").alias("hosted_key"))
    p = c.withColumn("name", F.when((F.col("conv_id") % 3 == 0) & (F.col("pos") == 0), "?").otherwise(F.col("name")))
    return R.zip_verified(p, c.drop("hosted_key"), "conv_id")


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'missing' WHEN 1 THEN 'pending' WHEN 2 THEN 'applied' ELSE 'changed' END AS state FROM orders")
def live_plan_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-09, CDC-09: planned rows against what is live."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    live = o.where("o_orderkey % 4 <> 0").select("o_orderkey", F.when(k % 4 == 1, "a").when(k % 4 == 2, "b").otherwise("c").alias("fingerprint"))
    return R.plan_state(o.select("o_orderkey", F.lit("a").alias("before"), F.lit("b").alias("after")), live, "o_orderkey")


@query("SELECT p_brand, CAST(p_partkey AS BIGINT) AS p_partkey, 'missing' AS side FROM part WHERE p_partkey % 10 = 0 UNION ALL SELECT p_brand || '!', p_partkey, 'unexpected' FROM part WHERE p_partkey % 10 = 0")
def readback_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC-07: what was written against what should have been."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    written = p.withColumn("p_brand", F.when(F.col("p_partkey") % 10 == 0, F.concat("p_brand", F.lit("!"))).otherwise(F.col("p_brand")))
    return R.readback(p, written)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M') ELSE '2020-01-01' END AS written FROM orders")
def best_written_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-08, HTM-07: a date with a time before one without."""
    a = F.array(F.lit("2020-01-01"), F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm")).otherwise("2021-01-01"))
    return table(spark, sf_dir, "orders").select("o_orderkey", R.best_written_at(a).alias("written"))


@query("SELECT doc_id, CASE WHEN doc_id % 150 > 100 THEN 'items' WHEN n_chars > 2000 THEN 'url' END AS fault FROM documents")
def payload_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-18: the first limit that a payload breaks."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", R.over_limits(F.array_repeat(F.lit(1), (F.col("doc_id") % 150).cast("int")), F.col("text"), F.col("text")).alias("fault"))


@query("SELECT event_id, CASE event_id % 4 WHEN 1 THEN 'depth' WHEN 2 THEN 'integer' WHEN 3 THEN 'syntax' END AS fault FROM events")
def json_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-17: limits on JSON before it is taken apart."""
    k = F.col("event_id")
    text = F.when(k % 4 == 1, F.concat(F.repeat(F.lit("["), F.lit(65)), F.repeat(F.lit("]"), F.lit(65)))).when(k % 4 == 2, '{"a":9223372036854775808}').when(k % 4 == 3, '{"a":').otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", R.json_fault(text).alias("fault"))


@query("SELECT event_id, '{\"a\":[{\"k\":1}],\"b\":' || json_extract_string(props, '$.k') || '}' AS stable FROM events")
def stable_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-08, HSH-04: JSON without what changes by itself, keys sorted at every depth."""
    text = F.concat(F.lit('{"b":'), F.get_json_object("props", "$.k"), F.lit(',"expiry_time":"'), "event_id", F.lit('","a":[{"signature":2,"k":1}]}'))
    return table(spark, sf_dir, "events").select("event_id", R.stable_json(text).alias("stable"))


@query("""
WITH e AS (SELECT user_id, event_type AS k, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS v FROM events),
x AS (SELECT user_id, v FROM e WHERE k = 'view' EXCEPT SELECT user_id, v FROM e WHERE k = 'click'), y AS (SELECT * FROM x UNION SELECT user_id, v FROM e WHERE k = 'error')
SELECT u.user_id, CASE WHEN count(y.v) <= 25 THEN coalesce(string_agg(y.v, ',' ORDER BY length(y.v), y.v), '') END AS ids FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN y USING (user_id) GROUP BY 1
""")
def pending_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-07, JON-04: pending ids after a run: those of views, without those of clicks, with those of errors; null where there
    are over twenty-five."""
    e = table(spark, sf_dir, "events").withColumn("v", F.floor("value").cast("bigint").cast("string"))
    own = lambda kind: F.collect_set(F.when(F.col("event_type") == kind, F.col("v")))  # noqa: E731  bounded by the limit on pending ids
    x = e.groupBy("user_id").agg(own("view").alias("old"), own("click").alias("gone"), own("error").alias("new"))
    return x.select("user_id", F.array_join(R.merge_pending(F.col("old"), F.col("gone"), F.col("new"), 25), ",").alias("ids"))


@query("SELECT s_suppkey, sha256('=' || s_suppkey || chr(0) || '=' || s_name || chr(0) || '-') AS operation_id FROM supplier")
def operation_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED-04, DED-05: keys of an operation from its content, which a repeat has again."""
    return table(spark, sf_dir, "supplier").select("s_suppkey", fingerprint(F.col("s_suppkey"), F.col("s_name"), F.lit(None).cast("string")).alias("operation_id"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'new' ELSE s_name END AS s_name, CAST(s_nationkey AS INT) AS s_nationkey FROM supplier WHERE s_suppkey % 7 <> 0 UNION ALL SELECT s_suppkey + 1000000, 'added', NULL FROM supplier WHERE s_suppkey % 6 = 0")
def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-02, SNK-03: inserts, partial updates and deletions in one pass."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    k = F.col("s_suppkey")
    new = s.where("s_suppkey % 5 = 0 OR s_suppkey % 7 = 0").select("s_suppkey", F.lit("new").alias("s_name"), (k % 7 == 0).alias("gone"))
    more = s.where("s_suppkey % 6 = 0").select((k + 1_000_000).alias("s_suppkey"), F.lit("added").alias("s_name"), F.lit(False).alias("gone"))
    return sinks.upsert(s, new.unionByName(more), ["s_suppkey"], "gone")


@query("SELECT r_regionkey, r_name, CAST(NULL AS VARCHAR) AS note FROM region")
def schema_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-05, FLT-20: columns added where they are missing."""
    r = table(spark, sf_dir, "region")
    return sinks.migrate(r, T.StructType([*r.schema.fields, T.StructField("note", T.StringType())]), True)


@query("SELECT DISTINCT lang AS name FROM documents WHERE lang NOT IN ('en', 'de')")
def missing_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC-14: members that an enumeration lacks."""
    have = spark.createDataFrame([("en",), ("de",)], "name string")
    return table(spark, sf_dir, "documents").select(F.col("lang").alias("name")).distinct().join(have, "name", "left_anti")


@query("WITH q AS (SELECT DISTINCT source FROM documents WHERE doc_id % 90 = 0) SELECT source, 'destination_pending_quarantine' AS code, true AS fatal FROM q WHERE source <> 'src0'")
def quarantine_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC-15: one more issue per quarantined source that has none yet."""
    q = table(spark, sf_dir, "documents").where("doc_id % 90 = 0").select("source").distinct()
    have = spark.createDataFrame([("src0",)], "source string")
    return q.join(have, "source", "left_anti").select("source", F.lit("destination_pending_quarantine").alias("code"), F.lit(True).alias("fatal"))


@query("SELECT o_orderkey, o_custkey % 2 = 0 AS owned, o_custkey % 2 = 0 AND o_orderstatus = 'O' AND o_orderkey % 3 = 0 AS pending, o_orderpriority = '1-URGENT' AND o_orderkey % 5 <> 0 AS keeps_pin FROM orders")
def pending_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC-10, FLT-11, FLT-16: owned rows that are pending, and pins that a plan leaves alone."""
    k = F.col("o_orderkey")
    owned = F.col("o_custkey") % 2 == 0
    return table(spark, sf_dir, "orders").select("o_orderkey", owned.alias("owned"), (owned & (F.col("o_orderstatus") == "O") & (k % 3 == 0)).alias("pending"), ((F.col("o_orderpriority") == "1-URGENT") & (k % 5 != 0)).alias("keeps_pin"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE epoch_us(CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate ELSE o_orderdate - INTERVAL 9 HOUR END) END AS us FROM orders")
def utc_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DAT-02, DAT-03: ISO texts with or without a zone; others give null."""
    k, at = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(k % 3 == 0, at).when(k % 3 == 1, F.concat(at, F.lit("+09:00"))).otherwise("yesterday")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.unix_micros(F.try_to_timestamp(text)).alias("us"))


@query("""
WITH u AS (SELECT page_id, url, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS source, regexp_extract(url, '^https?://[^/]+/[a-z]+/([0-9]+)', 1) AS id FROM pages)
SELECT page_id, 'https://' || host || '/list?configFk=' || source || '&page=2' AS list_url, 'https://' || host || '/' || source || '/' || id AS detail_url, url = 'https://' || host || '/' || source || '/' || id AS is_detail FROM u
""")
def built_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL-05, URL-06, FLT-10: addresses built from host, source and id, and told from others by building them again."""
    from ..functions import urls as U

    get = lambda i: F.regexp_extract("url", r"^https?://([^/]+)/([a-z]+)/(\d+)", i)
    detail = U.detail_address(get(1), get(2), get(3))
    return table(spark, sf_dir, "pages").select("page_id", U.list_address(get(1), get(2), 2).alias("list_url"), detail.alias("detail_url"), (F.col("url") == detail).alias("is_detail"))


@query("SELECT lang AS name, min(doc_id) AS doc_id FROM documents GROUP BY 1 ORDER BY 2 LIMIT 3")
def first_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-04, WIN-07: keys once, in the order of their first place, up to a limit."""
    return R.first_places(table(spark, sf_dir, "documents").select(F.col("lang").alias("name"), "doc_id"), ["name"], "doc_id", 3)


@query("SELECT event_type AS source, count(*) AS observed, count(*) FILTER (value > 100) AS failed, min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us FROM events GROUP BY 1")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-06, PRJ-02: one row of figures per source of a run."""
    e = table(spark, sf_dir, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    return e.groupBy(F.col("event_type").alias("source")).agg(F.count(F.lit(1)).alias("observed"), F.count_if(F.col("value") > 100).alias("failed"), F.min("us").alias("first_us"), F.max("us").alias("last_us"))


@query("""
WITH h AS (SELECT page_id, regexp_extract(url, '^https?://([^/]*)', 1) AS host, url FROM pages)
SELECT page_id, unnest(range(5)) AS ix, unnest(['see (', url, '), or ', 'www.' || host, '.; end']) AS text, unnest([NULL, url, NULL, 'https://www.' || host, NULL]) AS link FROM h
""")
def text_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-05, ARR-02: texts in parts with their links."""
    from ..functions.urls import text_with_links

    host = F.regexp_extract("url", "^https?://([^/]*)", 1)
    text = F.concat(F.lit("see ("), "url", F.lit("), or www."), host, F.lit(".; end"))
    x = table(spark, sf_dir, "pages").select("page_id", F.posexplode(text_with_links(text)).alias("ix", "p"))
    return x.select("page_id", F.col("ix").cast("bigint").alias("ix"), "p.text", "p.link")


@query("SELECT page_id, page_id % 3 = 0 AS public FROM pages")
def public_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-08: addresses of the public network."""
    from ..functions.urls import public_address

    k = F.col("page_id")
    a = F.when(k % 3 == 0, "93.184.216.34").when(k % 3 == 1, "192.168.0.1").otherwise("no address")
    return table(spark, sf_dir, "pages").select("page_id", public_address(a).alias("public"))


@query("SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'pdf' WHEN 1 THEN 'text' END AS kind, page_id % 3 = 0 AS fits FROM pages")
def file_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BIN-01 to BIN-07, DED-07: what kind of file bytes prove to be, and whether the name says so."""
    from ..functions.binary import file_kind, fits_name

    k = F.col("page_id")
    content = F.when(k % 3 == 0, F.lit("%PDF-1.4\n%%EOF")).when(k % 3 == 1, F.lit("plain")).otherwise(F.lit("\0\x01")).cast("binary")
    return table(spark, sf_dir, "pages").select("page_id", file_kind(content).alias("kind")).select("page_id", "kind", fits_name(F.col("kind"), F.lit("a.PDF")).alias("fits"))

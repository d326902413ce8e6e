"""Queries of the scalar functions over driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import values as V
from ..functions.text import DETAIL_IDS, WS
from .changes import FIRST_LINE
from .registry import query, table



def squeezed(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{WS}+', ' ', 'g'), '^{WS}+|{WS}+$', '', 'g')"



@query(f"""
SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN lang ELSE '' END, ''), nullif({FIRST_LINE}, ''), 'untitled-' || doc_id) AS title FROM (SELECT doc_id, lang, CASE WHEN doc_id % 4 = 1 THEN '' ELSE text END AS text FROM documents)
""")
def title_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-09, STR-02: own title, else the first body line, else one made of the id."""
    k = F.col("doc_id")
    title = X.title_or_fallback(F.when(k % 3 == 0, F.col("lang")).otherwise(""), F.when(k % 4 == 1, "").otherwise(F.col("text")), k.cast("string"), F.lit(None).cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", title.alias("title"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN 'general' WHEN p_partkey % 4 = 2 THEN replace(p_type, ' ', ' ') || '/' || p_brand ELSE p_type END AS label FROM part
""")
def title_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-10: the label in front of a title."""
    k = F.col("p_partkey")
    title = F.when(k % 4 == 3, F.col("p_name")).when(k % 4 == 2, F.concat(F.lit("  [ "), "p_type", F.lit(" ,/ "), "p_brand", F.lit("] "), "p_name")).otherwise(F.concat(F.lit("["), "p_type", F.lit("] "), "p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", X.title_label(title).alias("label"))


@query(f"SELECT doc_id, {squeezed('text')} AS line, lower({squeezed('text')}) AS key FROM documents")
def text_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-01, STR-08, STR-09: white space as single spaces."""
    return table(spark, sf_dir, "documents").select("doc_id", X.squeeze(F.col("text")).alias("line"), X.title_key(F.col("text")).alias("key"))


#: The rules of masking, spelt out for DuckDB and not taken from the library's table.
MASKED = r"""
WITH a AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g') AS x FROM documents),
b AS (SELECT doc_id, regexp_replace(x, 'https?://([^\s/@]*@)?([^\s/?#"''<>]+)([^\s?#"''<>]*)[^\s"''<>]*', '\2\3', 'g') AS x FROM a),
c AS (SELECT doc_id, regexp_replace(x, '((?i:authorization|cookie)["'']?\s*[:=]\s*)((")([^"\\\r\n]|\\.)*"|('')([^''\\\r\n]|\\.)*''|[^\r\n]+)', '\1\3\5[REDACTED]\3\5', 'g') AS x FROM b),
d AS (SELECT doc_id, regexp_replace(x, '((?i:pass(?:word|wd|phrase)|secret|token|sig(?:nature)?|(?:api|access|private)[-_]?key|(?:request|database|data[-_]?source|page)[-_]?id)["'']?\s*[:=]\s*)((")([^"\\\r\n]|\\.)*"|('')([^''\\\r\n]|\\.)*''|["'']?[^]\s"'',;&}]+)', '\1\3\5[REDACTED]\3\5', 'g') AS x FROM c),
e AS (SELECT doc_id, regexp_replace(x, '\b((?i:bearer)\s+[A-Za-z0-9_.~+/=-]{8,}|(secret_|ntn_|github_pat_|gh[oprsu]_|sk-)[A-Za-z0-9_-]{8,}|AKIA[A-Za-z0-9_-]{12,})', '[REDACTED]', 'g') AS x FROM d),
f AS (SELECT doc_id, regexp_replace(x, '\beyJ[A-Za-z0-9_-]{8,}(\.[A-Za-z0-9_-]+){1,2}', '[REDACTED]', 'g') AS x FROM e),
g AS (SELECT doc_id, regexp_replace(x, '\b[0-9A-Fa-f]{8}-?([0-9A-Fa-f]{4}-?){3}[0-9A-Fa-f]{12}\b', '[ID]', 'g') AS x FROM f)
"""


@query(MASKED + f"SELECT doc_id, left({squeezed('x')}, 500) AS redacted FROM g")
def redact_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-07, STR-08: text for a log, with addresses cut and secrets masked."""
    return table(spark, sf_dir, "documents").select("doc_id", X.sanitize(F.col("text")).alias("redacted"))


_IDS = ", ".join(f"nullif(regexp_extract(u, '{p.replace(chr(39), chr(39) * 2)}', 1), '')" for p in DETAIL_IDS)


@query(f"SELECT page_id, coalesce({_IDS}) AS detail_id FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN url || '&pkId=' || page_id WHEN 1 THEN 'javascript:detail(''' || page_id || ''')' WHEN 2 THEN 'https://h/board/detail/' || page_id ELSE url END AS u FROM pages)")
def id_from_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-06, FLT-10: an id by the first form that fits."""
    k = F.col("page_id")
    u = F.when(k % 4 == 0, F.concat("url", F.lit("&pkId="), k)).when(k % 4 == 1, F.concat(F.lit("javascript:detail('"), k, F.lit("')"))).when(k % 4 == 2, F.concat(F.lit("https://h/board/detail/"), k)).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", X.detail_id(u).alias("detail_id"))


@query("""
WITH u AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS base FROM pages)
SELECT page_id, regexp_replace(base, '^([a-z]+://[^/]*).*$', '\\1') || regexp_replace(base, '^[a-z]+://[^/]*', '') || '?fileid=' || page_id || '&sg=9' AS identity FROM u
""".replace("\\\\", "\\"))
def attachment_identity_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL-03: the query keys that tell files apart, sorted; a rotating signature changes nothing."""
    base = F.regexp_replace("url", "[?#].*$", "")
    u = F.concat(base, F.lit("?SG=9&signature=abc"), F.lit("&page=1&fileId="), "page_id", F.lit("#x"))
    return table(spark, sf_dir, "pages").select("page_id", V.identity_url(u).alias("identity"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL WHEN 2 THEN epoch_us(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) - INTERVAL 9 HOUR) ELSE epoch_us(o_orderdate - INTERVAL 9 HOUR) END AS us FROM orders
""")
def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DAT-01: dates with dots or dashes, and runs of digits; what is no date gives null."""
    k, at = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    text = F.when(k % 4 == 0, F.date_format(at, "yyyy.MM.dd HH:mm:ss")).when(k % 4 == 1, F.date_format(at, "yyyyMMddHHmmss")).when(k % 4 == 2, F.date_format(at, "yyyy-MM-dd")).otherwise("2024-13-45")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.unix_micros(V.source_date(text)).alias("us"))


@query("""
SELECT p_partkey, try_cast(regexp_replace(p_brand, '[^0-9]', '', 'g') AS BIGINT) AS n, CASE WHEN p_partkey % 3 = 0 THEN 7 ELSE CAST(greatest(0, ceil(p_retailprice)) AS BIGINT) END AS whole FROM part
""")
def int_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NUM-01, NUM-02: digits of a text, and counts that may not be negative."""
    price = F.when(F.col("p_partkey") % 3 == 0, "n/a").otherwise(F.col("p_retailprice").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", V.digits_int(F.col("p_brand")).alias("n"), V.whole_number(price, 7).alias("whole"))


@query("""
WITH c AS (SELECT p_partkey, (p_partkey * 37) % 256 AS ri, (p_partkey * 101) % 256 AS gi, (p_partkey * 59) % 256 AS bi FROM part),
f AS (SELECT p_partkey, ri / 255.0::DOUBLE AS r, gi / 255.0::DOUBLE AS g, bi / 255.0::DOUBLE AS b FROM c), m AS (SELECT *, greatest(r, g, b) AS t, least(r, g, b) AS w FROM f), l AS (SELECT *, (t + w) / 2 AS lt, t - w AS d FROM m),
h AS (SELECT *, CASE WHEN d = 0 THEN 0 ELSE d / CASE WHEN lt > 0.5 THEN 2.0 - t - w ELSE t + w END END AS s, 60 * CASE WHEN d = 0 THEN 0 WHEN t = r THEN (g - b) / d + CASE WHEN g < b THEN 6.0 ELSE 0.0 END WHEN t = g THEN (b - r) / d + 2.0 ELSE (r - g) / d + 4.0 END AS hue FROM l)
SELECT p_partkey, CASE WHEN s < 0.15 THEN CASE WHEN lt < 0.35 THEN 'default' ELSE 'gray' END WHEN hue < 20 OR hue >= 345 THEN 'red' WHEN hue < 45 THEN 'orange' WHEN hue < 65 THEN 'yellow' WHEN hue < 150 THEN 'green' WHEN hue < 250 THEN 'blue' WHEN hue < 290 THEN 'purple' ELSE 'pink' END AS colour FROM h
""")
def css_colour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NUM-03: a colour as one of nine names."""
    k = F.col("p_partkey")
    r, g, b = (k * 37 % 256).cast("int"), (k * 101 % 256).cast("int"), (k * 59 % 256).cast("int")
    text = F.when(k % 2 == 0, F.format_string("#%02X%02x%02x", r, g, b)).otherwise(F.format_string("rgb(%d, %d,%d)", r, g, b))
    return table(spark, sf_dir, "part").select("p_partkey", V.css_colour(text).alias("colour"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN CAST(least(604800, 86400 * (p_partkey % 28)) AS DOUBLE) ELSE greatest(0.0, least(604800.0, CAST((p_partkey - 10) * 1000 AS DOUBLE))) END AS wait_s FROM part")
def retry_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DAT-05: seconds to wait, within bounds, from a number or a date."""
    k = F.col("p_partkey")
    date = F.concat(F.lit("Thu, "), F.lpad((1 + k % 28).cast("string"), 2, "0"), F.lit(" Feb 2024 00:00:00 GMT"))
    return table(spark, sf_dir, "part").select("p_partkey", V.retry_after(F.when(k % 5 == 0, "soon").when(k % 5 == 1, date).otherwise(((k - 10) * 1000).cast("string")), F.lit("2024-02-01 00:00:00").cast("timestamp")).alias("wait_s"))


@query("""
WITH c AS (SELECT doc_id, text, unnest(generate_series(0, greatest(length(text) - 1, 0), 1900)) AS p FROM documents WHERE length(text) > 0)
SELECT doc_id, CAST(p // 1900 AS INT) AS nth, substr(text, CAST(p + 1 AS BIGINT), 1900) AS chunk FROM c
""")
def chunk_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSN-02, ARR-02: long texts in pieces."""
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(X.chunks(F.col("text"))).alias("nth", "chunk"))


@query("""
SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'a b.pdf' WHEN 1 THEN 'r-' || page_id || '.docx' ELSE 'file' END AS filename, CASE page_id % 3 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document' END AS mime FROM pages
""")
def filename_mime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-04, MIM-01: a file's name from its URL, and its type by a join on the extension."""
    k = F.col("page_id")
    u = F.when(k % 3 == 0, F.lit("https://h/files/a%20b.pdf?x=1")).when(k % 3 == 1, F.concat(F.lit("https://h/?filename=r-"), k, F.lit(".docx"))).otherwise(F.lit("https://h/"))
    # Types by extension.
    kinds = {"pdf": "application/pdf", "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation", "hwp": "application/x-hwp", "zip": "application/zip", "png": "image/png", "jpg": "image/jpeg", "gif": "image/gif", "txt": "text/plain"}
    types = spark.createDataFrame(list(kinds.items()), "ext string, mime string")
    x = table(spark, sf_dir, "pages").select("page_id", X.filename_from_url(u).alias("filename")).withColumn("ext", F.lower(F.regexp_extract("filename", r"\.([A-Za-z0-9]+)$", 1)))
    return x.join(F.broadcast(types), "ext", "left").select("page_id", "filename", "mime")  # a table of ten rows


@query("SELECT c_custkey, octet_length(encode(name)) <= 40 AS fits, right(name, 4) = '.pdf' AS ext FROM (SELECT c_custkey, repeat('é', 18) || '.pdf' AS name FROM customer)")
def utf8_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-03: names cut to a number of bytes between characters, with their extension."""
    cut = X.truncate_utf8(F.concat(F.repeat(F.lit("é"), F.lit(60)), F.lit(".pdf")), 40)
    x = table(spark, sf_dir, "customer").select("c_custkey", cut.alias("name"))
    return x.select("c_custkey", (F.octet_length("name") <= 40).alias("fits"), F.col("name").endswith(".pdf").alias("ext"))


@query("""
SELECT o_orderkey, o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderdate <= TIMESTAMP '2001-01-02' AS plausible FROM orders
""")
def plausible_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-02: from the year 2000 to a day after now."""
    at = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select("o_orderkey", at.between(F.lit("2000-01-01").cast("timestamp"), F.lit("2001-01-02").cast("timestamp")).alias("plausible"))

"""JSON as rows: values with their paths, on the JVM, a level of nesting at a time; and hashes that do not depend on the order of keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage import cut

DEPTH = 64
IN_ONE_PASS = 8  # levels that are opened in one pass, where no text has more opening brackets


def _type(v: str) -> Column:
    kind = F.schema_of_variant(v)
    return F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null").otherwise("number")


def _leaf(v: str) -> Column:
    return ~_type(v).isin("object", "array") | F.expr(f"coalesce(to_json({v}) IN ('{{}}', '[]'), false)")


def _told(now: DataFrame, key: str) -> DataFrame:
    """Of now(key, path, v) the values that are no containers, and the empty containers, with type and text."""
    told = now.where(_leaf("v")).select(key, "path", _type("v").alias("type"), "v")
    return told.select(key, "path", "type", F.when(~F.col("type").isin("object", "array", "null"), F.expr("try_variant_get(v, '$', 'string')")).alias("value"))


def _opened(now: DataFrame, key: str, levels: int, dropped: tuple[str, ...]) -> DataFrame:
    """now(key, path, v) with so many levels of containers opened where they stand; other values stay as they are."""
    for _ in range(levels):
        view = f"variants_{uuid.uuid4().hex}"
        now.createOrReplaceTempView(view)
        path = "CASE WHEN e.value IS NULL THEN path WHEN e.key IS NULL THEN concat(path, '[', e.pos, ']') ELSE concat(path, '.', e.key) END"
        now = now.sparkSession.sql(f"SELECT `{key}`, {path} AS path, coalesce(e.value, v) AS v, e.key AS name FROM {view}, LATERAL variant_explode_outer(v) AS e")
        now = (now.where(~F.coalesce(F.col("name").isin(*dropped), F.lit(False))) if dropped else now).drop("name")
    return now


def leaves(rows: DataFrame, key: str, text: str, depth: int = DEPTH, dropped: tuple[str, ...] = ()) -> DataFrame:
    """rows(key, text of JSON): a row for every value that is no container, and for every empty container: key, path
    (`$.a[0].b`), type (number, string, boolean, null, object, array), value as a text. Below a name in `dropped` nothing is
    kept. A text that is no JSON has no rows; one nested deeper than `depth` is an error, not cut."""
    spark, kept = rows.sparkSession, None
    now = rows.select(key, F.lit("$").alias("path"), F.expr(f"try_parse_json(`{text}`)").alias("v")).where("v IS NOT NULL")
    most = rows.agg(F.max(F.length(text) - F.length(F.translate(text, "{[", "")))).first()[0] or 0  # no text is nested deeper
    if most <= min(depth, IN_ONE_PASS):
        return _told(_opened(now, key, most, dropped), key)
    for _ in range(depth + 1):
        done = _told(now, key)
        kept = done if kept is None else kept.unionByName(done)
        inside = now.where(~_leaf("v"))
        view = f"variants_{uuid.uuid4().hex}"
        inside.createOrReplaceTempView(view)
        below = spark.sql(f"SELECT `{key}`, concat(path, CASE WHEN e.key IS NULL THEN concat('[', e.pos, ']') ELSE concat('.', e.key) END) AS path, e.value AS v, e.key AS name FROM {view}, LATERAL variant_explode(v) AS e")
        now = cut(below.where(~F.coalesce(F.col("name").isin(*dropped), F.lit(False))).drop("name") if dropped else below.drop("name"))
        if now.isEmpty():
            return kept
    raise ValueError(f"a text is nested deeper than {depth} levels")


def canonical_hash(told: DataFrame, key: str) -> DataFrame:
    """key, hash: over all values of a text in the order of their paths, each with its type. Equal for texts that differ in
    the order of their keys or in white space alone. A text's values are one group."""
    one = F.concat_ws("\x1f", "path", "type", F.coalesce(F.concat(F.lit("="), "value"), F.lit("-")))
    return told.groupBy(key).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(one)), "\x1e"), 256).alias("hash"))

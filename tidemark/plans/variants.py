"""Queries of JSON as rows. Roles: an event is a stored page; its properties stand in a text with a list, a signed address and gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import variants as V
from .registry import query, table

TEXT = """concat('{"b": ', props, ', "a": [', user_id, ', "', event_type, '", null, {"url": "http://h/', event_id, '", "on": true}], "e": []', CASE WHEN event_id % 3 = 0 THEN '' ELSE ', "o": {}' END, CASE WHEN event_id % 50 = 0 THEN '' ELSE '}' END)"""
LEAVES = f"""
WITH t AS (SELECT event_id, {TEXT} AS text FROM events), k AS (
  SELECT t.event_id, j.fullkey AS path, CASE j.type WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' ELSE 'number' END AS type, CASE WHEN j.type NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN j.atom ->> '$' END AS value
  FROM (SELECT * FROM t WHERE json_valid(text)) t, json_tree(CAST(t.text AS JSON)) j WHERE j.atom IS NOT NULL OR j.type = 'NULL' OR CAST(j.value AS VARCHAR) IN ('{{}}', '[]'))
"""


def _leaves(spark: SparkSession, sf_dir: str, dropped: tuple[str, ...] = ()) -> DataFrame:
    return V.leaves(table(spark, sf_dir, "events").select("event_id", F.expr(TEXT).alias("text")), "event_id", "text", dropped=dropped)


@query(LEAVES + "SELECT event_id, path, type, value FROM k")
def json_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-08: every value of a JSON text with its path and type."""
    return _leaves(spark, sf_dir)


@query(LEAVES + "SELECT event_id, sha256(string_agg(path || chr(31) || type || chr(31) || coalesce('=' || value, '-'), chr(30) ORDER BY encode(path || chr(31) || type || chr(31) || coalesce('=' || value, '-')))) AS hash FROM k WHERE path <> '$.a[3].url' GROUP BY 1")
def json_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HSH-04: a hash of what a JSON text says, without what changes by itself, whatever the order of its keys."""
    return V.canonical_hash(_leaves(spark, sf_dir, ("url",)), "event_id")

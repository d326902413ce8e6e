"""Records of items, destination rows and their blocks: projections, codecs and matches."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip

# Keys of stored values that change without the value changing.
VOLATILE = frozenset({"expiry_time", "last_edited_time", "last_edited_by", "signature", "request_id", "formula", "rollup"})
MARKER = "SYNC_BODY"


def destination_row(items: DataFrame, required: dict[str, Column], optional: dict[str, Column]) -> DataFrame:
    """Typed columns of a destination row. `present` names the optional ones that the item has: what is not named is left
    alone by a write, which a null would not be."""
    present = F.filter(F.array(*(F.when(c.isNotNull(), F.lit(k)) for k, c in optional.items())), lambda x: x.isNotNull())
    return items.select(*(c.alias(k) for k, c in (required | optional).items()), F.array_join(present, ",").alias("present"))


def complete_items(items: DataFrame, complete: Column, title: Column, url: Column) -> tuple[DataFrame, DataFrame]:
    """Items that may go on, and those that may not, with a reason."""
    reason = F.when(~F.coalesce(complete, F.lit(False)), "incomplete").when(strip(F.coalesce(title, F.lit(""))) == "", "no_title").when(F.coalesce(url, F.lit("")) == "", "no_url")
    x = items.withColumn("reason", reason)
    return x.where("reason IS NULL").drop("reason"), x.where("reason IS NOT NULL")


def allowed_keys(mapping: Column, keys: tuple[str, ...]) -> Column:
    return F.map_filter(mapping, lambda k, v: k.isin(*keys))


def last_two(a: Column) -> Column:
    return F.slice(a, F.greatest(F.lit(1), F.size(a) - 1), F.lit(2))


def marker(generation: Column, part: Column, parts: Column, sha: Column) -> Column:
    """The header that a body's container carries: who wrote it, which part of which generation, and of what content."""
    return F.concat_ws("\n", F.lit(MARKER), F.concat(F.lit("GENERATION:"), generation, F.lit(":"), part, F.lit("/"), parts), F.concat(F.lit("CONTENT_SHA256:"), sha))


def read_marker(text: Column) -> Column:
    """generation, part, parts and sha of a header; null for anything that is not one in full."""
    line = lambda n: F.split_part(text, F.lit("\n"), F.lit(n))
    get = lambda i: F.regexp_extract(line(2), r"^GENERATION:([A-Za-z0-9-]+):(\d{1,4})/(\d{1,4})$", i)
    sha = F.regexp_extract(line(3), "^CONTENT_SHA256:([0-9a-f]{64})$", 1)
    part, parts = get(2).try_cast("int"), get(3).try_cast("int")
    ok = (line(1) == MARKER) & (sha != "") & part.between(1, parts)
    return F.when(ok, F.struct(get(1).alias("generation"), part.alias("part"), parts.alias("parts"), sha.alias("sha")))


def whole_generations(blocks: DataFrame, key: str) -> DataFrame:
    """blocks(key, generation, part, parts): one row per generation, and whether all its parts are there once."""
    g = blocks.groupBy(key, "generation").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("part").alias("d"), F.min("parts").alias("lo"), F.max("parts").alias("hi"))
    return g.select(key, "generation", "n", ((F.col("n") == F.col("d")) & (F.col("lo") == F.col("hi")) & (F.col("n") == F.col("hi"))).alias("whole"))


def match_media(stored: DataFrame, live: DataFrame, key: str) -> DataFrame:
    """stored(key, block_id, type, hosted_key) against live(the same): per key `valid`, `drift` if the counts, a block, its
    type or its file differ, or `unavailable` if a stored entry names no block."""
    s = stored.groupBy(key).agg(F.count(F.lit(1)).alias("n_stored"), F.bool_or(F.col("block_id").isNull()).alias("unnamed"))
    l = live.groupBy(key).agg(F.count(F.lit(1)).alias("n_live"))
    b = live.select(key, "block_id", F.col("type").alias("t"), F.col("hosted_key").alias("h"))
    same = F.coalesce((F.col("type") == F.col("t")) & (F.col("hosted_key") == F.col("h")), F.lit(False))
    m = stored.join(b, [key, "block_id"], "left").groupBy(key).agg(F.bool_and(same).alias("same"))
    status = F.when(F.col("n_stored") != F.coalesce("n_live", F.lit(0)), "drift").when(F.col("unnamed"), "unavailable").when(~F.col("same"), "drift").otherwise("valid")
    return s.join(l, key, "left").join(m, key).select(key, status.alias("status"))


def zip_verified(properties: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """properties(key, pos, name, hosted_key) and state(key, pos, name): joined by place, for a key only if all names agree
    and both lists are as long."""
    p = properties.select(key, "pos", F.col("name").alias("p_name"), "hosted_key")
    x = state.join(p, [key, "pos"], "full")
    ok = x.groupBy(key).agg(F.bool_and(F.coalesce(F.col("name") == F.col("p_name"), F.lit(False))).alias("ok"))
    return x.join(ok.where("ok"), key).select(key, "pos", "name", "hosted_key")


def plan_state(plan: DataFrame, live: DataFrame, key: str) -> DataFrame:
    """plan(key, before, after) against live(key, fingerprint): pending, applied, changed or missing."""
    x = plan.join(live, key, "left")
    f = F.col("fingerprint")
    return x.select(key, F.when(f.isNull(), "missing").when(f == F.col("before"), "pending").when(f == F.col("after"), "applied").otherwise("changed").alias("state"))


def readback(wanted: DataFrame, written: DataFrame) -> DataFrame:
    """Rows that are wanted and not written, or written and not wanted, counting repeats."""
    a, b = wanted.exceptAll(written), written.exceptAll(wanted)
    return a.withColumn("side", F.lit("missing")).unionByName(b.withColumn("side", F.lit("unexpected")))


def best_written_at(values: Column) -> Column:
    """The first value with a time of day, else the first."""
    timed = F.filter(values, lambda v: v.rlike(r"\d{2}:\d{2}"))
    return F.coalesce(F.try_element_at(timed, F.lit(1)), F.try_element_at(values, F.lit(1)))


def over_limits(items: Column, url: Column, body: Column) -> Column:
    """The first limit of a payload that is broken: 100 items, 2,000 characters of URL, 500 KiB of body."""
    return F.when(F.size(items) > 100, "items").when(F.length(url) > 2_000, "url").when(F.octet_length(body) > 500 * 1024, "body")


def merge_pending(old: Column, recovered: Column, unresolved: Column, most: int = 1_000) -> Column:
    """(old without recovered) with unresolved, in the order of digit strings; null beyond the bound."""
    ids = F.array_union(F.array_except(old, recovered), unresolved)
    ordered = F.transform(F.array_sort(F.transform(ids, lambda i: F.struct(F.length(i).alias("n"), i.alias("i")))), lambda x: x.i)
    return F.when(F.size(ids) <= most, ordered)


def _strip(x):
    if isinstance(x, dict):
        return {k: _strip(v) for k, v in sorted(x.items()) if k not in VOLATILE}
    return [_strip(v) for v in x] if isinstance(x, list) else x.split("?")[0] if isinstance(x, str) and "X-Amz-" in x else x


def stable_one(text: str | None) -> str | None:
    """A JSON text with sorted keys and without what changes by itself; null if it is no JSON."""
    try:
        return json.dumps(_strip(json.loads(text)), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    except (TypeError, ValueError, RecursionError):
        return None


def json_fault_one(text: str | None, depth: int = 64, nodes: int = 100_000) -> str | None:
    """What is wrong with a JSON text before it is parsed into values: too deep, too many nodes, too large an integer."""
    level = most = count = 0
    quoted = escaped = False
    for c in text or "":
        if quoted:
            escaped, quoted = c == "\\" and not escaped, c != '"' or escaped
        elif c == '"':
            quoted = True
        elif c in "[{":
            level, count = level + 1, count + 1
            most = max(most, level)
        elif c in "]}":
            level -= 1
        elif c == ",":
            count += 1
    if most > depth:
        return "depth"
    if count > nodes:
        return "nodes"
    try:
        big: list[bool] = []
        json.loads(text or "", parse_int=lambda s: big.append(len(s) > 19 or not -(1 << 63) <= int(s) < 1 << 63))
        return "integer" if any(big) else None
    except ValueError:
        return "syntax"


def _mapped(f):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(f)

    return F.pandas_udf(run, T.StringType())


stable_json, json_fault = _mapped(stable_one), _mapped(json_fault_one)


def first_places(rows: DataFrame, keys: list[str], order: str, limit: int) -> DataFrame:
    """Each key once, in the order of its first place, and of those the first so many."""
    return rows.groupBy(*keys).agg(F.min(order).alias(order)).orderBy(order).limit(limit)


def flatten(results: DataFrame, items: str) -> DataFrame:
    """Items of every result in the order of the results, with both places."""
    return results.select("source_ord", F.posexplode(items).alias("item_ord", "item")).withColumn("place", F.row_number().over(Window.partitionBy("source_ord").orderBy("item_ord")).cast("bigint"))

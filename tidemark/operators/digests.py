"""Differences of two tables located by digests of key ranges, so that only ranges that differ are compared row by row; the
figures of a pass observed in that pass."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .lineage import cut

RANGES = 4_096


def in_range(keys: list[str], ranges: int = RANGES) -> Column:
    """The range of a key: by a hash, with a mark for each null, which the hash skips."""
    return F.pmod(F.xxhash64(*[c for k in keys for c in (F.col(k).isNull(), F.col(k))]), F.lit(ranges)).cast("int")


def digests(rows: DataFrame, keys: list[str], columns: list[str], ranges: int = RANGES) -> DataFrame:
    """Of every range that has rows: their number, and two sums of row hashes, kept whole as decimals. A row per range at
    most, so a table's digests can be kept beside it, and a level above them is the same sum over blocks of ranges."""
    fields = [c for k in (*keys, *columns) for c in (F.col(k).isNull(), F.col(k))]
    row = lambda salt: F.sum(F.xxhash64(*fields, F.lit(salt)).cast("decimal(38,0)"))
    return rows.groupBy(in_range(keys, ranges).alias("range")).agg(F.count(F.lit(1)).alias("n"), row(1).alias("a"), row(2).alias("b"))


def differing(old: DataFrame, new: DataFrame) -> DataFrame:
    """Of two tables of digests: the ranges that are not the same in both."""
    o, n = (x.select("range", F.struct("n", "a", "b").alias(name)) for x, name in ((old, "old"), (new, "new")))
    return o.join(n, "range", "full").where(~F.col("old").eqNullSafe(F.col("new"))).select("range")


def differences(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], ranges: int = RANGES, kept: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """keys, kind (`missing` in new, `extra`, `changed`), and the columns that changed. `kept`: digests of the two that were
    stored before; else both are summed first. Rows in ranges that agree take no part in a shuffle."""
    told = kept or (digests(old, keys, columns, ranges), digests(new, keys, columns, ranges))
    where = F.broadcast(differing(*told))  # a row per range at most
    o, n = (x.select(*keys, *columns, in_range(keys, ranges).alias("range")).join(where, "range", "left_semi").select(*keys, F.struct(*columns).alias(side)).withColumn(f"in_{side}", F.lit(True)) for x, side in ((old, "o"), (new, "n")))
    o, n = o.alias("x"), n.alias("y")
    both = o.join(n, reduce(and_, [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in keys]), "full")
    changed = F.filter(F.array(*(F.when(~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")), F.lit(c)) for c in columns)), lambda c: c.isNotNull())
    kind = F.when(F.col("in_n").isNull(), "missing").when(F.col("in_o").isNull(), "extra").when(F.size(changed) > 0, "changed")
    named = [F.coalesce(F.col(f"x.{k}"), F.col(f"y.{k}")).alias(k) for k in keys]
    return both.select(*named, kind.alias("kind"), F.when(kind == "changed", changed).otherwise(F.array().cast("array<string>")).alias("columns")).where("kind IS NOT NULL")


def rollback(plan: DataFrame, applied: DataFrame, before: DataFrame, keys: list[str], order: str) -> DataFrame:
    """CDC-11. plan(keys, order, action), applied(keys): the steps that were carried out, undone from the last to the first: a
    created row is taken away, a changed one gets back the row it had. Adds step (1 is the first to be undone) as an order to
    sort by, not a number, so that no task ranks all steps."""
    done = plan.join(applied.select(*keys).distinct(), keys, "left_semi")
    old = before.select(*keys, F.struct(*[c for c in before.columns if c not in keys]).alias("restore"))
    return done.join(old, keys, "left").select(*keys, (-F.col(order)).alias("undo_order"), F.when(F.col("action") == "create", "archive").otherwise("restore").alias("undo"), F.when(F.col("action") != "create", F.col("restore")).alias("restore"))


def measured(rows: DataFrame, figures: dict[str, Column]) -> tuple[DataFrame, dict]:
    """rows, written once, and aggregates of them that were observed as they were written: no second pass."""
    seen = Observation()
    kept = cut(rows.observe(seen, *(c.alias(n) for n, c in figures.items())))
    return kept, seen.get

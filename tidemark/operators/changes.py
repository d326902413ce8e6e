"""Change planning: what must happen to a destination so that it holds the items of a source.

Joins are on (source, id) with plain equi-joins, so adaptive execution may broadcast or split them by measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["source", "item_id"]


def lookup(items: DataFrame, dest: DataFrame) -> DataFrame:
    """items joined to dest rows by key, with `matches`, how many dest rows the key has: over one is an error to report."""
    count = dest.groupBy(*KEY).agg(F.count(F.lit(1)).alias("matches"))
    return items.join(count, KEY, "left").withColumn("matches", F.coalesce("matches", F.lit(0).cast("bigint")))


def mutation_plan(items: DataFrame, dest: DataFrame, confirmed: DataFrame, quarantined: list[str]) -> DataFrame:
    """items(source, item_id, title, body_hash), dest(the same), confirmed(source, item_id, body_hash): changes of a body
    seen in the run before as well. One row per action: source, item_id, kind, reason. An item may need two actions."""
    old = dest.select(*KEY, F.col("title").alias("old_title"), F.col("body_hash").alias("old_hash"), F.lit(True).alias("there"))
    seen = confirmed.select(*KEY, "body_hash", F.lit(True).alias("seen")).distinct()
    x = items.join(old, KEY, "left").join(seen, [*KEY, "body_hash"], "left")
    known, body = F.col("there").isNotNull(), ~F.col("body_hash").eqNullSafe(F.col("old_hash"))
    title = ~F.col("title").eqNullSafe(F.col("old_title"))
    act = lambda kind, reason: F.struct(F.lit(kind).alias("kind"), F.lit(reason).alias("reason"))
    several = F.filter(F.array(F.when(title, act("update_properties", "title")), F.when(body, act("replace_body", "body_hash"))), lambda a: a.isNotNull())
    actions = (
        F.when(F.col("source").isin(*quarantined) if quarantined else F.lit(False), F.array(act("conflict", "source_quarantined")))
        .when(known & body & F.col("seen").isNull(), F.array(act("conflict", "unconfirmed_change")))
        .when(~known, F.array(act("create", "absent")))
        .when(title | body, several)
        .otherwise(F.array(act("noop", "equal")))
    )
    return x.select(*KEY, F.explode(actions).alias("a")).select(*KEY, "a.kind", "a.reason")


def property_diff(items: DataFrame, dest: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row per key and changed column. columns: name to kind, `minute` for timestamps compared by the minute."""
    new = items.select(*KEY, *(F.col(c).alias(f"n_{c}") for c in columns))
    old = dest.select(*KEY, *(F.col(c).alias(f"o_{c}") for c in columns))
    cut = lambda c, kind: F.date_trunc("minute", c) if kind == "minute" else F.col(c)
    changed = F.filter(F.array(*(F.when(~cut(f"n_{c}", k).eqNullSafe(cut(f"o_{c}", k)), F.lit(c)) for c, k in columns.items())), lambda x: x.isNotNull())
    return new.join(old, KEY).select(*KEY, F.explode(changed).alias("property"))


def consecutive(observation: Column, latest: Column, logical: Column, latest_logical: Column, current_logical: Column, seen: Column, now: Column, ttl: int = 10_800) -> Column:
    """True for an observation of the run just before, by another logical run than this one, at most ttl seconds ago."""
    age = F.unix_timestamp(now) - F.unix_timestamp(seen)
    return F.coalesce((observation == latest) & (logical == latest_logical) & (logical != current_logical) & age.between(0, ttl), F.lit(False))


def missing_pinned(dest: DataFrame, current: DataFrame, most: int = 20, share: float = 0.5) -> DataFrame:
    """Pinned dest rows (source, item_id) that the current pinned rows lack, with the guard's verdict for their source:
    blocked when over `most` are missing, or at least five are pinned and over `share` of them missing."""
    missing = dest.join(current.select(*KEY), KEY, "left_anti")
    total = dest.groupBy("source").agg(F.count(F.lit(1)).alias("pinned"))
    lost = missing.groupBy("source").agg(F.count(F.lit(1)).alias("missing"))
    guard = lost.join(total, "source").select("source", "missing", "pinned", ((F.col("missing") > most) | ((F.col("pinned") >= 5) & (F.col("missing") > share * F.col("pinned")))).alias("blocked"))
    return missing.select(*KEY).join(guard, "source")


def reusable_uploads(wanted: DataFrame, stored: DataFrame, key: list[str], order: str) -> DataFrame:
    """wanted rows matched to stored ones as multisets: the n-th wanted with a key takes the n-th stored with it."""
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(order))
    w, s = wanted.withColumn("nth", nth), stored.withColumn("nth", nth).select(*key, "nth", F.col(order).alias("stored_id"))
    out = w.join(s, [*key, "nth"], "left")
    return out.withColumn("action", F.when(F.col("stored_id").isNotNull(), "reuse").otherwise("upload"))

"""Quality gates: issue codes over sources and items, and which sources are safe to write after them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Codes that do not stop a source, and codes that stop every source.
SNAPSHOT = ("invalid_top_snapshot_url", "duplicate_top_snapshot_id", "top_snapshot_item_mismatch")
NOT_FATAL = ("atomic_snapshot_unavailable", *SNAPSHOT)
GLOBAL = ("duplicate_source", "cross_source_url_collision")


def _issue(df: DataFrame, when: Column, code: str, item: str | None = "item_id") -> DataFrame:
    return df.where(F.coalesce(when, F.lit(False))).select("source", (F.col(item) if item else F.lit(None)).cast("string").alias("item_id"), F.lit(code).alias("code"), F.lit(code not in NOT_FATAL).alias("fatal"))


def _told(rows: DataFrame, codes: dict[str, Column]) -> DataFrame:
    """A row for every code whose condition holds, all of them looked at in one pass."""
    found = F.filter(F.array(*(F.when(F.coalesce(when, F.lit(False)), F.lit(code)) for code, when in codes.items())), lambda x: x.isNotNull())
    return rows.select("source", F.col("item_id").cast("string").alias("item_id"), F.explode(found).alias("code")).withColumn("fatal", ~F.col("code").isin(*NOT_FATAL))


def item_issues(items: DataFrame) -> DataFrame:
    """items(source, source_ord, item_id, item_ord, verified_id, title, url, completeness, body_status, n_blocks,
    attachments_status, truncated, classification, expected). One row per broken rule. A row without title or url has no
    further checks. An id or url is a duplicate behind its first row in a source; a url is a collision in the first row of
    every source but the first that has it. What is shared is found by counts, so that no window holds the rows of a
    frequent key, and only what occurs twice is joined to the rows."""
    whole = F.coalesce((F.col("title") != "") & (F.col("url") != ""), F.lit(False))
    rest = items.where(whole)
    ids = rest.groupBy("source", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("_id")).agg(F.min("item_ord").alias("_id_first"), F.count(F.lit(1)).alias("n"))
    ids = ids.where("n > 1").drop("n")
    urls = rest.groupBy("source", F.col("url").alias("_url")).agg(F.min("item_ord").alias("_url_first"), F.min("source_ord").alias("_ord"), F.count(F.lit(1)).alias("n"))
    urls = urls.withColumn("_collides", F.col("_ord") > F.min("_ord").over(Window.partitionBy("_url")))  # a row per source
    urls = urls.where("n > 1 OR _collides").drop("n", "_ord")
    rows = items.withColumn("_id", F.coalesce(F.col("item_id").cast("string"), F.lit(""))).withColumn("_url", F.col("url")).join(ids, ["source", "_id"], "left").join(urls, ["source", "_url"], "left")
    has_blocks = F.col("n_blocks") > 0
    broken_body = ((F.col("body_status") == "present") & ~has_blocks) | ((F.col("body_status") == "confirmed_empty") & has_blocks) | ~F.col("body_status").isin("present", "confirmed_empty")
    return _told(rows, {
        "incomplete_item": F.col("completeness") != "complete",
        "body_completeness_invalid": broken_body,
        "attachment_completeness_invalid": (F.col("attachments_status") != "known") | F.col("truncated"),
        "invalid_item_identity": ~whole,
        "notice_identity_mismatch": whole & ~F.col("verified_id").eqNullSafe(F.col("item_id")),
        "duplicate_notice_id": whole & (F.col("item_ord") > F.col("_id_first")),
        "duplicate_source_url": whole & (F.col("item_ord") > F.col("_url_first")),
        "classification_mismatch": whole & (F.col("classification") != F.col("expected")),
        "cross_source_url_collision": whole & F.col("_collides") & (F.col("item_ord") == F.col("_url_first")),
    })


def snapshot_issues(results: DataFrame, pins: DataFrame, items: DataFrame) -> DataFrame:
    """Faults of pinned-list snapshots, in sources whose snapshot counts as verified. results(source, pins_verified),
    pins(source, pin_ord, pin_id): the snapshot in order, a null id where the url is not one of the source; items(source,
    item_id, pinned). A url that is wrong, an id behind its first place, a pinned item that the snapshot lacks."""
    verified = results.where("pins_verified").select("source").distinct()
    own = pins.join(verified, "source", "left_semi")
    bad = _issue(own, F.col("pin_id").isNull(), "invalid_top_snapshot_url", None)
    good = own.where("pin_id IS NOT NULL")
    first = good.groupBy("source", "pin_id").agg(F.min("pin_ord").alias("_first"), F.count(F.lit(1)).alias("_n"))
    again = good.join(first.where("_n > 1"), ["source", "pin_id"]).where("pin_ord > _first")
    there = first.select("source", F.col("pin_id").cast("string").alias("item_id"))
    pinned = items.where("pinned").select("source", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id")).join(verified, "source", "left_semi")
    lost = pinned.join(there, ["source", "item_id"], "left_anti")
    return reduce(DataFrame.unionByName, [bad, _issue(again, F.lit(True), "duplicate_top_snapshot_id", "pin_id"), _issue(lost, F.lit(True), "top_snapshot_item_mismatch")])


def revoke_snapshots(results: DataFrame, issues: DataFrame) -> DataFrame:
    """results with `pins_verified` taken back from every source that has one of the three faults, so that nothing is
    concluded from what its snapshot lacks."""
    wrong = issues.where(F.col("code").isin(*SNAPSHOT)).select("source", F.lit(True).alias("_wrong")).distinct()
    return results.join(wrong, "source", "left").withColumn("pins_verified", F.col("pins_verified") & F.col("_wrong").isNull()).drop("_wrong")


def source_issues(results: DataFrame, expected: DataFrame, previous: DataFrame, least: float = 0.25) -> DataFrame:
    """results(source, required, write_safe, reconcile, covered, termination, full_snapshot, status, n_items),
    expected(source), previous(source, n_items). A source's count collapses if a reading that covered it all has less than
    the share `least` of the last, which had five at least."""
    got = results.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    both = expected.select("source").distinct().withColumn("_expected", F.lit(True)).join(got, "source", "full").withColumn("item_id", F.lit(None).cast("string"))
    sets = _told(both, {"missing_source_result": F.col("n").isNull(), "unexpected_source_result": F.col("_expected").isNull(), "duplicate_source": F.col("n") > 1})
    was = results.join(previous.select("source", F.col("n_items").alias("_was")), "source", "left").withColumn("item_id", F.lit(None).cast("string"))
    asked = F.col("reconcile") & F.col("write_safe")
    return sets.unionByName(_told(was, {
        "required_source_unsafe": F.col("required") & ~F.col("write_safe"),
        "reconcile_incomplete": asked & ~F.col("covered") & ~F.col("termination").eqNullSafe(F.lit("backfill_window")),
        "atomic_snapshot_unavailable": asked & F.col("covered") & ~F.col("full_snapshot"),
        "unexpected_empty_source": F.col("status") == "confirmed_empty",
        "source_count_collapse": (F.col("status") == "success") & F.col("covered") & (F.col("_was") >= 5) & (F.col("n_items") < F.col("_was") * least),
    }))


def source_safety(results: DataFrame, issues: DataFrame) -> DataFrame:
    """Every source with whether a fatal issue is its own, whether a fatal global code stops all, and whether it may be
    written: write-safe, and neither of the two."""
    stop = issues.where(F.col("fatal") & F.col("code").isin(*GLOBAL)).agg((F.count(F.lit(1)) > 0).alias("stopped"))
    own = issues.where("fatal").select("source", F.lit(True).alias("faulty")).distinct()
    sources = results.groupBy("source").agg(F.bool_or("write_safe").alias("write_safe")).join(own, "source", "left")
    sources = sources.join(F.broadcast(stop), F.lit(True))  # one row on the right
    faulty = F.coalesce("faulty", F.lit(False))
    return sources.select("source", faulty.alias("faulty"), "stopped", (F.col("write_safe") & ~faulty & ~F.col("stopped")).alias("safe"))


def safe_sources(results: DataFrame, issues: DataFrame) -> DataFrame:
    """Sources that may be written: none if a global code is fatal, else the write-safe ones without a fatal issue."""
    return source_safety(results, issues).where("safe").select("source")


def body_status(n_blocks: Column, container: Column, closed: Column) -> Column:
    """Three values: what is there, what is surely empty, and what cannot be told."""
    return F.when(n_blocks > 0, "present").when(container & closed, "confirmed_empty").otherwise("unknown")


def attachments_status(n: Column, evidence: Column, most: int = 15) -> Column:
    return F.when(n > most, "unknown").when((n == 0) & evidence, "unknown").otherwise("known")


def missing_fields(fields: dict[str, Column]) -> Column:
    """Names of the fields whose condition holds, joined by commas; null if none does."""
    names = F.array_join(F.filter(F.array(*(F.when(c, F.lit(k)) for k, c in fields.items())), lambda x: x.isNotNull()), ",")
    return F.nullif(names, F.lit(""))

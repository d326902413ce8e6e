"""Rules of a paged scan as window and join steps over a table of list rows (source, page_no, pos, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4_096  # numbers of a source that are sorted together


def page_signatures(rows: DataFrame, keys: list[str], fields: list[str], order: str) -> DataFrame:
    """One row per page: a hash of its rows' fields in list order, and whether an earlier page of the source had it."""
    one = F.concat_ws("\x1f", *(F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields))
    pages = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, one.alias("x")))).alias("a"))
    return pages.select(*keys, F.sha2(F.array_join(F.transform("a", lambda x: x.x), "\x1e"), 256).alias("signature"))


def repeated_pages(signed: DataFrame, source: str, page: str) -> DataFrame:
    """Pages whose signature an earlier page of the same source has; signatures are keys, so no group grows large."""
    first = signed.groupBy(source, "signature").agg(F.min(page).alias("first_page"))
    return signed.join(first, [source, "signature"]).where(F.col(page) > F.col("first_page"))


def backfill_window(rows: DataFrame, known: DataFrame, source: str, key: str, order: list[str], limit: int = 20) -> DataFrame:
    """The first `limit` unknown rows of a source in list order, which are read, and the one after them, where to resume. The
    filter on the place lets every task keep that many rows of a source before the shuffle, so no source is sorted whole."""
    unknown = rows.join(known.select(source, key).distinct(), [source, key], "left_anti")
    nth = F.row_number().over(Window.partitionBy(source).orderBy(*order))
    return unknown.withColumn("nth", nth).where(F.col("nth") <= limit + 1).withColumn("nth", F.col("nth").cast("bigint")).withColumn("read", F.col("nth") <= limit)


def trailing_runs(rows: DataFrame, source: str, at: str, good: Column, name: str, block: int = BLOCK) -> DataFrame:
    """Adds how many rows in a row, up to and with each, are good, in the order of `at`, a whole number that is unique in its
    source. It is a row's place less that of the last row that is not good. Both are summed by blocks of `at`, so that no
    sort has more than `block` rows of a source: within blocks, over the blocks of a block of blocks, and over these, of
    which a source has one for `block` * `block` numbers."""
    part = lambda size: F.floor(F.col(at) / size)
    x = rows.select("*", F.coalesce(good, F.lit(False)).alias("_good"), part(block * block).alias("_over"), part(block).alias("_block"))
    own = Window.partitionBy(source, "_over", "_block").orderBy(at)
    x = x.withColumn("_nth", F.row_number().over(own)).withColumn("_bad", F.max(F.when(~F.col("_good"), F.col("_nth"))).over(own))

    def before(sums: DataFrame, keys: list[str], order: str, n: str, bad: str) -> DataFrame:
        """sums(_n, _last): rows, and the place of the last bad one. The same of all blocks before each."""
        earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        y = sums.withColumn(n, F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        return y.withColumn(bad, F.max(F.col(n) + F.col("_last")).over(earlier))

    blocks = x.groupBy(source, "_over", "_block").agg(F.count(F.lit(1)).alias("_n"), F.max(F.when(~F.col("_good"), F.col("_nth"))).alias("_last"))
    blocks = before(blocks, [source, "_over"], "_block", "_n1", "_bad1")
    overs = blocks.groupBy(source, "_over").agg(F.sum("_n").alias("_n"), F.max(F.col("_n1") + F.col("_last")).alias("_last"))
    overs = before(overs, [source], "_over", "_n2", "_bad2").select(source, "_over", "_n2", "_bad2")
    x = x.join(blocks.join(overs, [source, "_over"]).select(source, "_over", "_block", "_n1", "_bad1", "_n2", "_bad2"), [source, "_over", "_block"])
    last = F.coalesce(F.col("_n2") + F.col("_n1") + F.col("_bad"), F.col("_n2") + F.col("_bad1"), F.col("_bad2"), F.lit(0))
    return x.select(*rows.columns, (F.col("_n2") + F.col("_n1") + F.col("_nth") - last).alias(name))


def checkpoint_overlap(pages: DataFrame, source: str, page: str, block: int = BLOCK) -> DataFrame:
    """pages(source, page, known, unknown: counts of rows): for each page how many pages in a row, up to it, have a known
    row and no unknown one. Two or more close an incremental scan."""
    return trailing_runs(pages, source, page, (F.col("known") > 0) & (F.col("unknown") == 0), "overlap", block)


def totals_satisfied(rows: DataFrame, source: str, key: str, pinned: str, declared: DataFrame) -> DataFrame:
    """declared(source, total): whether the number of rows, or of ids that are not pinned, is what the source says."""
    seen = rows.groupBy(source).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.when(~F.col(pinned), F.col(key))).alias("n_ids"))
    return seen.join(declared, source).withColumn("satisfied", (F.col("total") == F.col("n_rows")) | (F.col("total") == F.col("n_ids")))


def duplicate_ids(rows: DataFrame, source: str, key: str, order: str, same: list[str]) -> DataFrame:
    """Rows after the first of their id, in list order: `allowed` only if they equal the row before in the fields given."""
    w = Window.partitionBy(source, key).orderBy(order)
    equal = F.lit(True)
    for c in same:
        equal = equal & F.col(c).eqNullSafe(F.lag(c).over(w))
    out = rows.select("*", F.row_number().over(w).alias("_nth"), equal.alias("allowed"))
    return out.where("_nth > 1").drop("_nth")


def best_source_result(results: DataFrame, key: str, safe: str, priority: str) -> DataFrame:
    """One result per source: a safe one before others, then by priority."""
    first = F.struct((~F.col(safe)).cast("int").alias("unsafe"), F.col(priority).alias("priority"))
    return results.groupBy(key).agg(F.min(first).alias("best")).select(key, (F.col("best.unsafe") == 0).alias(safe), F.col("best.priority").alias(priority))


def first_seen(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key by order; an aggregate, so a frequent key is reduced before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")


def details_agree(rows: DataFrame, details: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """List rows with whether their detail was found, and whether it says the same in all fields; an empty detail does not."""
    d = details.select(*key, *(F.col(f).alias(f"_{f}") for f in fields), F.lit(True).alias("_found"))
    same = F.lit(True)
    for f in fields:
        same = same & (F.col(f) == F.col(f"_{f}"))
    return rows.join(d, key, "left").select(*rows.columns, F.col("_found").isNotNull().alias("found"), F.coalesce(same, F.lit(False)).alias("agrees"))

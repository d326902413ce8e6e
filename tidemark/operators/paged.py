"""A paged list, read twice, judged as one scan: where it ends and why, what of it counts as seen, what is to be read.

pages(source, reading, page_no, ok, echo, total, has_more) has a row for every answer, rows(source, reading, page_no, pos,
item_id, title, date, pinned) the list rows; reading 1 is the scan and 2 the second pass over the same pages. Every rule is
a fault or an end of a page; the first page with one ends the scan, and on that page the rule that is looked at first. So
a source's windows are over its pages, of which there are `cap` at most, and its rows meet by page, id or place only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut

CAP, SIZE, DETAILS, NEAR = 100, 500, 20, 2

#: Rules in the order in which a page is looked at, with the reason that each ends a scan for.
RULES = ("hard_cap", "page_error", "page_echo", "total_changed", "total_below_observed", "resume_anchor_missing", "empty_unconfirmed", "empty_changed", "empty_unverified", "repeated_page", "entry_contract", "repeated_ids", "identity_collision", "total_mismatch", "end")
REASONS = {"hard_cap": "hard_cap", "resume_anchor_missing": "resume_error", "snapshot_changed": "snapshot_changed"}
SAFE = ("natural_end", "backfill_window")


def _signature(fields: list[str], when: Column | None = None) -> Column:
    """Of a page's rows in list order, or of those that `when` tells. A page has a bounded number of rows."""
    one = F.struct("pos", F.concat_ws("\x1f", *(F.coalesce(F.concat(F.lit("="), F.col(f).cast("string")), F.lit("-")) for f in fields)).alias("x"))
    rows = F.collect_list(one if when is None else F.when(when, one))
    return F.sha2(F.array_join(F.transform(F.array_sort(rows), lambda r: r["x"]), "\x1e"), 256)


def _again(signed: DataFrame, column: str) -> DataFrame:
    """Pages with a signature that an earlier page of their source has."""
    first = signed.groupBy("source", column).agg(F.min("page_no").alias("first"))
    return signed.join(first, ["source", column]).where("page_no > first").select("source", "page_no")


def _flag(pages: DataFrame, some: DataFrame, name: str) -> DataFrame:
    return pages.join(some.select("source", "page_no").distinct().withColumn(name, F.lit(True)), ["source", "page_no"], "left").withColumn(name, F.coalesce(name, F.lit(False)))


def scan(pages: DataFrame, rows: DataFrame, known: DataFrame, resume: DataFrame, cap: int = CAP, size: int = SIZE, details: int = DETAILS) -> tuple[DataFrame, DataFrame]:
    """known(source, item_id), resume(source, resume_page, anchors: array of ids where an earlier scan stopped).

    Two tables. One row per source: status, reason, error (rule and page), pages_scanned, observed (ids seen), resume_page and
    anchors for the next scan. And the rows that count, those up to the last good page: source, page_no, pos, item_id, pinned,
    read (whether its detail is read now: pinned and unknown ones, and the first `details` other unknown ones)."""
    pages, rows = pages.where(F.col("page_no") <= cap + 1), rows.where(F.col("page_no") <= cap)
    first, second = (pages.where(F.col("reading") == i).drop("reading") for i in (1, 2))
    own = rows.where("reading = 1").drop("reading")
    by_page = Window.partitionBy("source").orderBy("page_no")
    earlier = by_page.rowsBetween(Window.unboundedPreceding, -1)
    so_far = by_page.rowsBetween(Window.unboundedPreceding, 0)

    # all that is asked of a page's rows, in one pass
    broken = F.expr("item_id IS NULL OR title IS NULL OR NOT (item_id RLIKE '^[0-9]{1,32}$')")
    signed = rows.groupBy("source", "reading", "page_no").agg(F.count(F.lit(1)).alias("n"), _signature(["item_id", "title", "date"]).alias("signature"), _signature(["item_id", "pinned"], F.col("reading") == 1).alias("sequence"), F.bool_or(broken).alias("broken"))
    signed = cut(signed)
    n_rows = signed.select("source", "reading", "page_no", "n")
    x = first.join(n_rows.where("reading = 1").drop("reading"), ["source", "page_no"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    new = own.where("NOT pinned AND item_id IS NOT NULL").groupBy("source", "item_id").agg(F.min("page_no").alias("page_no")).groupBy("source", "page_no").agg(F.count(F.lit(1)).alias("new"))
    x = x.join(new, ["source", "page_no"], "left").withColumn("seen", F.coalesce(F.sum("new").over(so_far), F.lit(0)))
    x = x.withColumn("gap", F.col("page_no") - F.coalesce(F.lag("page_no").over(by_page), F.lit(0)) > 1).withColumn("short", F.coalesce(F.lag("n").over(by_page) < size, F.lit(False)))
    x = x.withColumn("declared", F.first("total", ignorenulls=True).over(by_page.rowsBetween(Window.unboundedPreceding, 0)))

    both = second.select("source", "page_no", F.col("ok").alias("ok2"), F.col("total").alias("total2"), F.col("has_more").alias("more2")).join(n_rows.where("reading = 2").select("source", "page_no", F.col("n").alias("n2")), ["source", "page_no"], "left")
    x = x.join(both, ["source", "page_no"], "left")
    once = signed.where("reading = 1")
    x = _flag(_flag(x, _again(once, "signature"), "again"), _again(once, "sequence"), "again_ids")
    x = _flag(x, once.where("broken"), "broken")
    place = F.struct("page_no", "pos")
    ids = own.groupBy("source", "item_id").agg(F.count(F.lit(1)).alias("k"), F.min_by(F.struct("title", "date", "pinned"), place).alias("was"), F.min(place).alias("at")).where("k > 1")
    ids = cut(ids)
    twice = own.join(ids, ["source", "item_id"]).where((place > F.col("at")) & (~F.col("pinned") | ~F.struct("title", "date", "pinned").eqNullSafe(F.col("was"))))
    x = _flag(x, twice, "collides")

    active = resume.where((F.col("resume_page") > 2) & (F.size("anchors") > 0)).select("source", "resume_page", F.explode("anchors").alias("item_id"))
    hit = own.where("NOT pinned").join(active, ["source", "item_id"]).where(F.col("page_no") >= F.greatest(F.lit(2), F.col("resume_page") - NEAR))
    found = hit.groupBy("source").agg(F.min("page_no").alias("found_at"))
    asked = active.select("source", F.col("resume_page").alias("asked")).distinct()
    x = x.join(asked, "source", "left").join(found, "source", "left")
    unanchored = F.col("asked").isNotNull() & (F.col("found_at").isNull() | (F.col("found_at") > F.col("page_no")))

    empty, same = F.col("n") == 0, F.col("total").eqNullSafe(F.col("total2")) & F.col("has_more").eqNullSafe(F.col("more2"))
    last = F.coalesce(~F.col("has_more"), F.lit(False))
    ends = last | (empty & ((F.col("page_no") == 1) | F.col("short")))
    x = x.withColumn("listed", F.coalesce(F.sum("n").over(so_far), F.lit(0)))  # all rows up to a page, pinned ones as often as they stand
    satisfied = F.col("declared").isNull() | (F.col("declared") == F.col("seen")) | (F.col("declared") == F.col("listed"))
    when: dict[str, Column] = {
        "hard_cap": F.col("page_no") > cap,
        "page_error": ~F.col("ok") | F.col("gap"),
        "page_echo": F.col("echo") != F.col("page_no"),
        "total_changed": F.col("total") != F.col("declared"),
        "total_below_observed": F.col("total") < F.col("seen"),
        "resume_anchor_missing": unanchored & (empty | (F.col("page_no") > F.col("asked") + NEAR)),
        "empty_unconfirmed": empty & (~F.coalesce("ok2", F.lit(False)) | (F.coalesce("n2", F.lit(0)) > 0)),
        "empty_changed": empty & ~same,
        "empty_unverified": empty & ~ends,
        "repeated_page": ~empty & F.col("again"),
        "entry_contract": F.col("broken"),
        "repeated_ids": ~empty & F.col("again_ids"),
        "identity_collision": F.col("collides"),
        "total_mismatch": ends & ~satisfied,
        "end": ends,
    }
    x = x.withColumn("rule", F.coalesce(*(F.when(F.coalesce(when[r], F.lit(False)), F.lit(r)) for r in RULES)))
    x = cut(x.select("source", "page_no", "rule"))  # a row per page, which all that follows asks for
    stop = x.where("rule IS NOT NULL").groupBy("source").agg(F.min(F.struct("page_no", "rule")).alias("stop")).select("source", F.col("stop.page_no").alias("stop"), F.col("stop.rule").alias("rule"))
    sources = x.groupBy("source").agg(F.max("page_no").alias("last_page")).join(stop, "source", "left")
    # pages that ran out without an end: the next one was never answered
    sources = sources.select("source", F.coalesce("rule", F.lit("page_error")).alias("rule"), F.coalesce("stop", F.col("last_page") + 1).alias("stop"))

    # pages whose rows count, and those that a second reading must agree with
    good = sources.select("source", F.when(F.col("rule") == "end", F.col("stop")).otherwise(F.col("stop") - 1).alias("upto"), (F.col("rule") == "end").alias("ended"))
    sure = signed.where("reading = 1").join(good, "source").where("ended AND page_no <= upto").select("source", "page_no", "signature")
    other = signed.where("reading = 2").select("source", "page_no", F.col("signature").alias("signature2")).join(second.where("ok").select("source", "page_no"), ["source", "page_no"], "left_semi")
    changed = sure.join(other, ["source", "page_no"], "left").where("signature2 IS NULL OR signature <> signature2").groupBy("source").agg(F.min("page_no").alias("changed"))

    counted = own.join(good.select("source", "upto"), "source").where("page_no <= upto").drop("upto")
    counted = counted.join(known.select("source", "item_id", F.lit(True).alias("known")).distinct(), ["source", "item_id"], "left")
    counted = counted.join(ids.select("source", "item_id", "at"), ["source", "item_id"], "left").withColumn("fresh", F.col("known").isNull() & (F.col("at").isNull() | (place == F.col("at"))))
    # the first so many unknown rows of a source by list order; a rank that is filtered keeps that many of a task's rows
    queue = counted.where("fresh AND NOT pinned").withColumn("nth", F.row_number().over(Window.partitionBy("source").orderBy("page_no", "pos"))).where(F.col("nth") <= details + 1)
    queue = queue.select("source", "page_no", "pos", "nth")
    taken = counted.join(queue, ["source", "page_no", "pos"], "left")
    read = F.coalesce(F.col("fresh") & (F.col("pinned") | (F.col("nth") <= details)), F.lit(False))
    taken = taken.select("source", "page_no", "pos", "item_id", "pinned", read.alias("read"))
    left = queue.where(F.col("nth") == details + 1).select("source", F.col("page_no").alias("next_page"))
    anchors = own.where("NOT pinned").join(left.select("source", F.col("next_page").alias("page_no")), ["source", "page_no"]).groupBy("source").agg(F.array_sort(F.collect_set("item_id")).alias("anchors"))

    seen = counted.groupBy("source").agg(F.count_distinct("item_id").alias("observed"))
    y = sources.join(changed, "source", "left").join(left, "source", "left").join(anchors, "source", "left").join(seen, "source", "left")
    rule = F.when(F.col("changed").isNotNull(), F.lit("snapshot_changed")).otherwise(F.col("rule"))
    why = reduce(lambda c, r: c.when(rule == r, REASONS[r]), REASONS, F.when(rule == "end", F.when(F.col("next_page").isNotNull(), "backfill_window").otherwise("natural_end"))).otherwise("page_error")
    status = F.when(rule != "end", "partial").when(F.coalesce("observed", F.lit(0)) == 0, "confirmed_empty").otherwise("success")
    error = F.when(rule != "end", F.concat(rule, F.lit(":"), F.coalesce("changed", "stop").cast("string")))
    scanned = F.when(F.col("rule").isin("hard_cap", "page_error", "page_echo"), F.col("stop") - 1).otherwise(F.col("stop"))
    result = y.select("source", status.alias("status"), why.alias("reason"), error.alias("error"), scanned.alias("pages_scanned"), F.coalesce("observed", F.lit(0)).alias("observed"), F.col("next_page").alias("resume_page"), F.coalesce("anchors", F.array().cast("array<string>")).alias("anchors"))
    return result, taken

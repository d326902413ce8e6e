"""What runs find out about sources, folded into each source's state: circuits, confirmations of emptiness, the cursor of a
backfill, marks of complete readings, and counts of observations in consecutive runs.

A report is a row per source and run: source, run_no (dense over all recorded runs), logical_id (attempts of one run share
it), at (seconds), status, method, category, write_safe, applied (whether the source's rows were written), reconcile (a full
reading was asked for), covered, complete, termination, n_items, retry_after, resume_page. The state after every report is
one row, so a batch of reports and a stream of them (`tidemark.streaming.reports`) can be held against each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Methods of reading that a failure of counts for the fallback's circuit, and those whose refusal is old news.
FALLBACK = ("fallback_http", "fallback_playwright")
CIRCUIT_OPEN = ("source_circuit_open", "host_circuit_open")
FAILURES, COOLDOWN, BLOCK_COOLDOWN, LONGEST_WAIT = 3, 10_800, 21_600, 604_800
MOST = 100  # a count of observations stops there

STATE = "source string, run_no long, last_attempt_at long, last_success_at long, failures long, fallback_open_until long, source_open_until long, empty_count long, empty_pending boolean, backfill_active boolean, backfill_started_at long, resume_page long, last_item_count long, last_covered_at long, last_full_at long"


def follows(run: Column, logical: Column, before_run: Column, before_logical: Column) -> Column:
    """Whether an observation is of the run right after that of the one before, and not another attempt of the same."""
    distinct = (logical == "") | ((before_logical != "") & (before_logical != logical))
    return F.coalesce((before_run == run - 1) & distinct, F.lit(False))


def report_states(reports: DataFrame, failures: int = FAILURES, cooldown: int = COOLDOWN, block_cooldown: int = BLOCK_COOLDOWN) -> DataFrame:
    """The state of a source after each of its reports, as columns of `STATE`. A source has one row a run, and all windows
    are over its runs, so rows are dealt by source once."""
    runs = Window.partitionBy("source").orderBy("run_no")
    so_far = runs.rowsBetween(Window.unboundedPreceding, 0)
    newest = lambda when, value: F.last(F.when(when, F.struct(value.alias("v"))), ignorenulls=True).over(so_far)["v"]  # noqa: E731  null, if that was set last
    none = lambda kind: F.lit(None).cast(kind)

    x = reports.withColumn("safe", F.coalesce("write_safe", F.lit(False)))
    x = x.withColumn("ok", F.col("safe") & F.coalesce("applied", F.lit(False))).withColumn("empty", F.col("ok") & (F.col("status") == "confirmed_empty"))
    x = x.withColumn("since_safe", F.sum(F.col("safe").cast("long")).over(runs))
    in_row = Window.partitionBy("source", "since_safe").orderBy("run_no").rowsBetween(Window.unboundedPreceding, 0)
    failed = ~F.col("safe") & F.col("method").isin(*FALLBACK)
    x = x.withColumn("failures", F.count_if(failed).over(in_row))
    x = x.withColumn("fallback_open_until", F.max(F.when(failed & (F.col("failures") >= failures), F.col("at") + cooldown)).over(in_row))
    refused = ~F.col("safe") & ((F.col("method") == "api_source_circuit_open") | ((F.col("category") == "security_policy") & ~F.col("method").isin(*CIRCUIT_OPEN)))
    wait = F.greatest(F.lit(block_cooldown), F.least(F.lit(LONGEST_WAIT), F.greatest(F.lit(0), F.coalesce("retry_after", F.lit(0)))))
    x = x.withColumn("source_open_until", F.last(F.when(refused, F.col("at") + wait), ignorenulls=True).over(in_row))

    # emptiness must be seen in two runs that follow each other
    again = F.lag("empty").over(runs) & follows(F.col("run_no"), F.col("logical_id"), F.lag("run_no").over(runs), F.lag("logical_id").over(runs))
    x = x.withColumn("again", F.col("empty") & F.coalesce(again, F.lit(False)))
    x = x.withColumn("streak", F.sum((F.col("empty") & ~F.col("again")).cast("long")).over(runs))
    streak = F.count_if("empty").over(Window.partitionBy("source", "streak").orderBy("run_no").rowsBetween(Window.unboundedPreceding, 0))
    x = x.withColumn("n_empty", F.when(F.col("empty"), streak))
    x = x.withColumn("empty_count", newest(F.col("ok"), F.col("n_empty"))).withColumn("empty_pending", F.coalesce(newest(F.col("ok"), F.col("empty") & ~F.col("again")), F.lit(False)))

    # the backfill: from the first window that ended early up to a reading that covered all
    covered = F.col("ok") & F.col("reconcile") & F.col("covered")
    window = F.col("ok") & ~(F.col("reconcile") & F.col("covered")) & (F.col("termination") == "backfill_window")
    lost = ~F.col("ok") & (F.col("termination") == "resume_error")
    x = x.withColumn("phase", F.sum(covered.cast("long")).over(runs))
    in_phase = Window.partitionBy("source", "phase").orderBy("run_no").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("backfill_started_at", F.min(F.when(window, F.col("at"))).over(in_phase)).withColumn("backfill_active", F.col("backfill_started_at").isNotNull())
    x = x.withColumn("resume_page", newest(covered | window | lost, F.when(window, F.col("resume_page")).otherwise(none("long"))))

    sure = covered & (~F.col("empty") | F.col("again"))
    for name, when, value in (("last_attempt_at", F.lit(True), "at"), ("last_success_at", F.col("ok"), "at"), ("last_item_count", sure, "n_items"), ("last_covered_at", sure, "at"), ("last_full_at", sure & F.col("complete"), "at")):
        x = x.withColumn(f"_{name}", newest(when, F.col(value)))
    kept = ("last_attempt_at", "last_success_at", "last_item_count", "last_covered_at", "last_full_at")
    fields = [f.split() for f in STATE.split(", ")]
    return x.select(*(F.col(f"_{n}" if n in kept else n).cast(kind).alias(n) for n, kind in fields))


def streaks(seen: DataFrame, keys: list[str], same: list[str] = (), most: int = MOST, ttl: int | None = None) -> DataFrame:
    """seen(keys, run_no, logical_id, and what must stay the `same`): adds in how many runs in a row up to this one the key
    was observed so, at most `most`. Another attempt of one run, a run left out, another value, or (with a column `at`) more
    than `ttl` seconds between two observations begins anew. A key has one row a run."""
    runs = Window.partitionBy(*keys).orderBy("run_no")
    on = follows(F.col("run_no"), F.col("logical_id"), F.lag("run_no").over(runs), F.lag("logical_id").over(runs))
    for c in same:
        on = on & F.col(c).eqNullSafe(F.lag(c).over(runs))
    if ttl is not None:
        on = on & (F.col("at") - F.lag("at").over(runs)).between(0, ttl)
    x = seen.withColumn("_new", F.sum((~F.coalesce(on, F.lit(False))).cast("long")).over(runs))
    return x.withColumn("observations", F.least(F.lit(most), F.row_number().over(Window.partitionBy(*keys, "_new").orderBy("run_no"))).cast("long")).drop("_new")


def latest_absences(looks: DataFrame, missing: DataFrame, most: int = MOST, ttl: int | None = None) -> DataFrame:
    """looks(source, run_no, logical_id, at): the runs in which a source was looked at; missing(source, run_no, item): what
    was not there. For the last look at each source, the missing items and in how many runs in a row they were."""
    last = looks.groupBy("source").agg(F.max("run_no").alias("last"))
    told = streaks(missing.join(looks.select("source", "run_no", "logical_id", "at"), ["source", "run_no"]), ["source", "item"], most=most, ttl=ttl)
    return told.join(last, "source").where("run_no = last").select("source", "item", "observations")


def confirmed_absent(absences: DataFrame, pinned: DataFrame, least: int = 2, most: int = 20, share: float = 0.5) -> DataFrame:
    """CDC-08. pinned(source, item): what the destination has pinned. Of those, what two runs in a row have not found, which
    is to be taken off; held, if there is so much of it that the reading itself is in doubt (the guard of `changes`)."""
    lost = absences.where(F.col("observations") >= least).join(pinned.select("source", "item"), ["source", "item"], "left_semi")
    have = pinned.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    gone = lost.groupBy("source").agg(F.count(F.lit(1)).alias("gone")).join(have, "source")
    held = (F.col("gone") > most) | ((F.col("n") >= 5) & (F.col("gone") > share * F.col("n")))
    return lost.join(gone.select("source", held.alias("held")), "source").select("source", "item", "observations", "held")

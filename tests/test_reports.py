"""The fold of reports: a batch and a stream give the same rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import reports as R
from tidemark.plans import reports as P
from tidemark.streaming import reports as S


def as_rows(df):
    names = [x.split()[0] for x in R.STATE.split(", ")]
    return sorted(df.select(*names).collect())


@pytest.fixture()
def streamed(spark, tmp_path):
    def run(df, op, name):
        """Two micro-batches, cut between two runs."""
        schema, at = df.schema, f"{tmp_path}/{name}"
        cut = df.agg(F.expr("percentile_approx(run_no, 0.5)")).first()[0]
        for i, part in enumerate((df.where(F.col("run_no") <= cut), df.where(F.col("run_no") > cut))):
            part.coalesce(1).write.parquet(f"{at}/in/{i}")
        (source := spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{at}/in"))
        q = op(source).writeStream.format("memory").queryName(name).option("checkpointLocation", f"{at}/state").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return spark.table(name)

    return run


def test_stream_and_batch_agree_row_by_row(spark, sf, streamed):
    reports = P.reports(spark, sf).withColumn("source", F.col("source").cast("string"))
    batch = as_rows(R.report_states(reports, failures=2))
    assert as_rows(streamed(reports, lambda s: S.fold_reports(s, failures=2), "states")) == batch
    assert any(r.fallback_open_until for r in batch) and any(r.source_open_until for r in batch) and any((r.empty_count or 0) > 1 for r in batch) and any(r.resume_page for r in batch) and any(r.last_full_at for r in batch)


def test_drawn_reports_agree(spark, streamed):
    r = random.Random(8)
    ddl = "source string, run_no long, logical_id string, at long, status string, method string, category string, write_safe boolean, applied boolean, reconcile boolean, covered boolean, complete boolean, termination string, n_items long, retry_after long, resume_page long"
    rows = []
    for s in "abcdef":
        for run in range(60):
            if r.random() < 0.85:
                flag = lambda p=0.6: r.random() < p
                rows.append((s, run, r.choice([str(run), str(run - run % 2), ""]), 1_000 * run, r.choice(["success", "confirmed_empty", "confirmed_empty", "failed"]), r.choice(["api", "fallback_http", "fallback_playwright", "api_source_circuit_open", "host_circuit_open"]), r.choice(["none", "none", "security_policy"]), flag(), flag(0.9), flag(), flag(0.4), flag(), r.choice(["natural_end", "backfill_window", "resume_error"]), run, r.choice([None, 5, 30_000, 10**9, -4]), r.choice([None, run])))
    df = spark.createDataFrame(rows, ddl).withColumn("safe_if", F.col("write_safe")).drop("safe_if")
    assert as_rows(streamed(df, S.fold_reports, "drawn")) == as_rows(R.report_states(df))


def test_absences_agree_and_stop_at_the_limit(spark, streamed):
    looks = [("s", n, str(n - (n == 7))) for n in (1, 2, 3, 5, 6, 7, 8, 9, 10, 11, 12)]
    missing = [("s", n, x) for _, n, _ in looks for x in "abc" if not (x == "b" and n == 11)]
    a, b = spark.createDataFrame(looks, "source string, run_no long, logical_id string").withColumn("at", F.col("run_no")), spark.createDataFrame(missing, "source string, run_no long, item string")
    assert sorted(tuple(r) for r in R.latest_absences(a, b, most=5).collect()) == [("s", "a", 5), ("s", "b", 1), ("s", "c", 5)]
    arrays = a.join(b.groupBy("source", "run_no").agg(F.collect_set("item").alias("missing")), ["source", "run_no"]).drop("at")
    out = streamed(arrays, lambda s: S.count_absences(s, most=5), "absences").where("run_no = 12").select("source", "item", "observations")
    assert sorted(tuple(r) for r in out.collect()) == [("s", "a", 5), ("s", "b", 1), ("s", "c", 5)]
    # another attempt of one run, and a run left out, begin anew
    told = R.streaks(b.join(a, ["source", "run_no"]), ["source", "item"]).where("item = 'a'").orderBy("run_no").collect()
    assert [r.observations for r in told] == [1, 2, 3, 1, 2, 1, 2, 3, 4, 5, 6]
    old = R.streaks(b.join(a.withColumn("at", F.col("run_no") * F.col("run_no")), ["source", "run_no"]), ["source", "item"], ttl=18).where("item = 'a' AND run_no > 8").orderBy("run_no").collect()
    assert [r.observations for r in old] == [3, 1, 1, 1]


@pytest.mark.parametrize("pinned, lost, held", [(4, 4, False), (5, 3, True), (6, 3, False), (50, 21, True)])
def test_much_absence_is_held(spark, pinned, lost, held):
    have = spark.range(pinned).select(F.lit("s").alias("source"), F.col("id").cast("string").alias("item"))
    absent = have.where(F.col("item").cast("int") < lost).withColumn("observations", F.lit(2)).unionByName(have.where("item = '99'").withColumn("observations", F.lit(1)))
    out = R.confirmed_absent(absent, have).collect()
    assert len(out) == lost and {r.held for r in out} == {held}



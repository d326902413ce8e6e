"""Signals of lasting failures against a plain walk through the messages."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import signals as S
from tidemark.operators import states
from tidemark.operators.groups import whole_groups


def walk(rows, window):
    """rows: (key, t, delivered). Signals by key and second, one message after the other."""
    seconds = {}
    for k, t, d in rows:
        n, was = seconds.get((k, t), (0, False))
        seconds[k, t] = n + 1, was or bool(d)
    out, last = [], {}
    for k, t in sorted(seconds, key=lambda x: (x[0] or "", x[1])):
        n, d = seconds[k, t]
        signals = k not in last or t - last[k] >= window
        if signals and d:
            last[k] = t
        out.append((k or "", t, n, d, signals))
    return sorted(out)


def marked(spark, rows, window, windows=S.EPOCH):
    df = spark.createDataFrame(rows, "key string, t long, ok boolean").repartition(3)
    return sorted((r.key or "", r.t, r.n, r.delivered, r.signals) for r in S.repeat_signals(df, ["key"], "t", window, "ok", windows).collect())


def test_a_failure_that_repeats_is_signalled_again_after_the_window(spark):
    ten = spark.range(10).select(F.lit("k").alias("key"), (F.col("id") * 5_000).alias("t"))
    told = [r.t for r in S.repeat_signals(ten, ["key"], "t", 21_600).where("signals").collect()]
    assert sorted(told) == [0, 25_000]


def test_a_signal_that_fails_is_repeated_at_the_next_message(spark):
    rows = [("k", t, t not in (0, 30, 140)) for t in range(0, 200, 10)]
    assert [t for _, t, _, _, s in marked(spark, rows, 100) if s] == [0, 10, 110]
    rows = [("k", t, t in (30, 150)) for t in range(0, 200, 10)]
    assert [t for _, t, _, _, s in marked(spark, rows, 100) if s] == [0, 10, 20, 30, 130, 140, 150]


@pytest.mark.parametrize("seed", range(4))
def test_signals_equal_a_walk(spark, seed):
    r = random.Random(seed)
    rows = [(f"k{i}", r.randint(-50, 400), r.random() < 0.7) for i in range(25) for _ in range(r.choice([1, 3, 40]))]
    rows += [(None, r.randint(0, 5_000), r.random() < (0.2, 1, 0.9, 0.5)[seed]) for _ in range(1_500)]
    rows += [("late", t, None) for t in range(0, 3_000, 7)] + [("late", 3_500, True), ("late", 3_501, True)]
    assert marked(spark, rows, 37, (1, 2, 3, 16)[seed]) == walk(rows, 37)


def test_signals_of_nothing(spark):
    assert marked(spark, [], 10) == []


def test_incidents_name_the_last_signal(spark):
    rows = spark.createDataFrame([(t, f"read of http://h/{t} failed after {t} s") for t in (0, 100, 950, 1_800)], "t long, text string")
    out = states.incidents(rows.withColumn("ts", F.timestamp_seconds("t")), F.col("text"), "ts", 900).collect()
    assert [(r.n, r.signals, r.delivered, r.last_at, r.last_signal_at) for r in out] == [(4, 2, 2, 1_800, 950)]


def test_no_table_cuts_a_group(spark):
    def sizes(batches):
        import pyarrow as pa

        for t in whole_groups(batches, ["k", "j"], 10):
            found = {(a, b) for a, b in zip(t.column("k").to_pylist(), t.column("j").to_pylist(), strict=True)}
            yield pa.RecordBatch.from_pylist([{"k": a, "j": b} for a, b in found])

    df = spark.range(500).select(F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("j"))
    got = df.repartition(2, "k", "j").sortWithinPartitions("k", "j").mapInArrow(sizes, "k long, j long").collect()
    assert len(got) == len(set(got)) == 21

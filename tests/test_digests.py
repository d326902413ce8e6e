"""Located differences and observed figures."""

from pyspark.sql import functions as F

from tidemark.operators import digests as D

DDL = "k string, j long, x string, y long"


def test_differences_are_located_and_only_their_ranges_are_read(spark):
    rows = [(f"k{i % 5}" if i % 11 else None, i, f"x{i}", i if i % 3 else None) for i in range(500)]
    new = [r for r in rows if r[1] != 7] + [(None, 9_999, "n", None)]
    new = [(*r[:2], "other", None if r[1] == 20 else r[3]) if r[1] in (20, 33) else r for r in new]
    a, b = (spark.createDataFrame(x, DDL).repartition(3) for x in (rows, new))
    got = sorted((r.j, r.kind, r.columns) for r in D.differences(a, b, ["k", "j"], ["x", "y"], 64).collect())
    assert got == [(7, "missing", []), (20, "changed", ["x", "y"]), (33, "changed", ["x"]), (9_999, "extra", [])]
    assert D.differing(D.digests(a, ["k", "j"], ["x", "y"], 64), D.digests(b, ["k", "j"], ["x", "y"], 64)).count() <= 4
    assert D.differences(a, a, ["k", "j"], ["x", "y"]).count() == 0 and D.differences(a.limit(0), a.limit(0), ["k", "j"], ["x", "y"]).count() == 0


def test_a_value_that_moves_between_columns_is_a_difference(spark):
    a, b = spark.createDataFrame([("k", 1, "v", None)], "k string, j long, x string, y string"), spark.createDataFrame([("k", 1, None, "v")], "k string, j long, x string, y string")
    assert [r.columns for r in D.differences(a, b, ["k", "j"], ["x", "y"]).collect()] == [["x", "y"]]


def test_figures_come_from_the_pass_that_writes(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(len(b))
            yield b

    rows, seen = D.measured(spark.range(1_000).mapInArrow(count, "id long"), {"n": F.count(F.lit(1)), "top": F.max("id")})
    assert seen == {"n": 1_000, "top": 999} and rows.count() == 1_000 and read.value == 1_000

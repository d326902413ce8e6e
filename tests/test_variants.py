"""JSON as rows: levels opened in one pass, and level by level, give the same rows."""

from pyspark.sql import functions as F

from tidemark.operators import variants as V

TEXTS = ['{"a": [1, {"b": null, "url": {"x": 1}}, []], "c": {}, "d": "{[", "e": true}', "[]", "{}", "null", "3", '"x"', "[null, [[1.5]]]", '{"a": ', None, '{"url": 1}']


def test_levels_in_one_pass_as_level_by_level(spark, monkeypatch):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    told = lambda dropped: sorted(map(tuple, V.leaves(rows, "id", "text", dropped=dropped).collect()), key=str)
    cuts, cut = [], V.cut
    monkeypatch.setattr(V, "cut", lambda df: cuts.append(1) or cut(df))
    once = [told(()), told(("url",))]
    assert not cuts  # nothing was written between the levels
    monkeypatch.setattr(V, "IN_ONE_PASS", 0)
    assert [told(()), told(("url",))] == once and cuts
    assert (0, "$.a[1].b", "null", None) in once[0] and (0, "$.c", "object", None) in once[0] and (6, "$[1][0][0]", "number", "1.5") in once[0]
    assert sum(r[0] == 0 for r in once[0]) == 7 and sum(r[0] == 0 for r in once[1]) == 6


def test_deep_texts_are_opened_level_by_level(spark):
    rows = spark.createDataFrame([(1, "[" * 20 + "7" + "]" * 20)], "id long, text string")
    assert [tuple(x) for x in V.leaves(rows, "id", "text").collect()] == [(1, "$" + "[0]" * 20, "number", "7")]
    assert V.canonical_hash(V.leaves(rows, "id", "text"), "id").where(F.col("hash").isNotNull()).count() == 1

"""Nested blocks and conflicts against plain walks."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import trees as T


def forest(seed, n=120, roots=4):
    r = random.Random(seed)
    rows = [(i, None if i < roots else r.randrange(max(0, i - 30), i) if seed % 2 else r.randrange(i), r.randrange(5), f"t{r.randrange(9)}") for i in range(n)]
    return [(100 + i, None if p is None else 100 + p, pos, t) for i, p, pos, t in rows]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, parent long, pos long, text string").repartition(3)


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def folded(rows, part):
    below = {}
    for i, p, pos, _ in rows:
        below.setdefault(p, []).append((pos, i))
    text = {i: t for i, _, _, t in rows}

    def sign(i):
        groups = {}
        for pos, c in sorted(below.get(i, [])):
            groups.setdefault(pos // part, []).append(sign(c))
        return sha(sha(text[i]) + ":" + ",".join(sha(",".join(groups[g])) for g in sorted(groups)))

    return {i: sign(i) for i in text}


@pytest.mark.parametrize("seed", [1, 2])
def test_signatures_equal_a_fold(spark, seed, monkeypatch):
    monkeypatch.setattr(T, "PART", 2)
    rows = forest(seed)
    got = {r.id: r.signature for r in T.signatures(frame(spark, rows), F.col("text")).collect()}
    assert got == folded(rows, 2)
    leaf = rows[-1]
    above, changed = dict((i, p) for i, p, *_ in rows), T.signatures(frame(spark, [*rows[:-1], (*leaf[:3], "other")]), F.col("text")).collect()
    path, at = set(), leaf[0]
    while at is not None:
        path.add(at)
        at = above[at]
    assert {r.id for r in changed if got[r.id] != r.signature} == path


def test_descent_tells_what_it_does_not_reach(spark):
    rows = [(1, None, 0, ""), (2, 1, 0, ""), (3, 2, 0, ""), (4, 3, 0, ""), (5, 4, 0, ""), (6, 99, 0, ""), (7, 8, 0, ""), (8, 7, 0, ""), (9, 6, 0, "")]
    b = frame(spark, rows)
    reached = T.descend(b, 2)
    assert sorted(tuple(r) for r in reached.collect()) == [(1, 1, 0, None), (2, 1, 1, 1), (3, 1, 2, 2)]
    assert sorted((r.id, r.why) for r in T.cut_off(b, reached, 2).collect()) == [(4, "too_deep"), (5, "unreached"), (6, "orphan"), (7, "unreached"), (8, "unreached"), (9, "unreached")]
    assert T.descend(b.limit(0)).count() == 0 and T.signatures(b.limit(0), F.col("text")).count() == 0


def test_a_chain_of_forty_levels(spark):
    rows = [(i, i - 1 if i else None, 0, "x") for i in range(40)]
    assert T.descend(frame(spark, rows)).agg(F.max("depth")).first()[0] == 39
    got = {r.id: r.signature for r in T.signatures(frame(spark, rows), F.col("text")).collect()}
    assert got == folded(rows, T.PART)


def test_media_of_a_page(spark):
    b = frame(spark, [(1, None, 0, ""), (2, 1, 0, ""), (3, 2, 0, ""), (4, None, 0, ""), (5, None, 0, ""), (6, 5, 0, ""), (7, None, 0, ""), (8, 7, 0, "")])
    live = spark.createDataFrame([(2, "image", "a"), (3, "file", "b"), (6, "image", "c"), (8, "image", "d")], "id long, kind string, key string")
    stored = spark.createDataFrame([(1, 2, "image", "a"), (1, 3, "file", "b"), (4, 4, "image", "z"), (5, 6, "image", None), (7, 8, "file", "d")], "root long, id long, kind string, key string")
    assert {r.root: r.status for r in T.held_media(T.descend(b), live, stored).collect()} == {1: "valid", 4: "drift", 5: "unavailable", 7: "drift"}


def test_conflicts_are_groups_with_their_members(spark):
    edges = [(1, 10), (2, 20), (3, 30), (4, 30), (4, 40), (5, 40), (6, 60), (6, 61), (7, 70), (7, 70)]
    df = spark.createDataFrame(edges, "item long, row long")
    got = sorted(tuple(r) for r in T.conflict_groups(df).collect())
    assert got == [("item", 3, 3), ("item", 4, 3), ("item", 5, 3), ("item", 6, 6), ("row", 30, 3), ("row", 40, 3), ("row", 60, 6), ("row", 61, 6)]
    assert T.conflict_groups(df.where("item < 3")).count() == 0

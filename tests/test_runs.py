"""Sources, sinks, state and control: behaviour over several runs."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import control, sinks
from tidemark.operators import changes, states, validation
from tidemark.sources import board, files

ROWS = {"a": [{"pkId": str(i), "title": f"t{i}"} for i in range(7)], "b": []}


def fetch(source, page, size):
    """A transport for the tests."""
    if source == "bad":
        return {"rows": "no"}
    if source == "endless":
        return {"rows": [{"pkId": str(page)}], "total": 1, "has_more": True}
    rows = ROWS[source]
    part = rows[(page - 1) * size : page * size]
    return {"rows": part, "total": len(rows), "has_more": page * size < len(rows)}


def test_board_source(spark):
    board.register(spark)
    df = spark.read.format("board").option("sources", "a,b,bad,endless").option("transport", "tests.test_runs:fetch").option("pageSize", "3").option("pages", "4").load()
    rows = df.collect()
    a = [r for r in rows if r.source == "a"]
    assert [(r.page_no, r.pos, json.loads(r.raw)["pkId"], r.total, r.has_more) for r in a] == [(i // 3 + 1, i % 3, str(i), 7, i < 6) for i in range(7)]
    assert [r.error[:10] for r in rows if r.source == "bad"] == ["page_error"]
    assert [r.error for r in rows if r.source == "endless"] == [None] * 4 + ["hard_cap"]


def test_captured_pages(spark, tmp_path):
    pages = [{"source": "a", "page": 1, "pageSize": 2, "total": 3, "hasNextPage": True, "isLastPage": False, "list": [{"id": 1}, {"id": 2}]}, {"source": "a", "page": 2, "pageSize": 2, "total": 3, "hasNextPage": True, "isLastPage": True, "list": [{"id": 3}]}, {"source": "a", "page": 3}]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, pages)))
    rows = files.captured_pages(spark, f"{tmp_path}/p.json").orderBy("page_no", "pos").collect()
    assert [(r.page_no, r.pos, r.error, r.has_more) for r in rows] == [(1, 0, None, True), (1, 1, None, True), (2, 0, "flags", True), (3, None, "no_list", False)]


def test_settings():
    assert files.settings("# c\nexport A = 'x y'\nA=2\nB=\"q\"\n=z\nno") == {"A": "2", "B": "q"}
    assert files.value_map("1:a;2=b,1=c\n:x;3:") == {"1": "c", "2": "b"}


def test_versions_conflict_crash_and_rollback(spark, tmp_path):
    t = sinks.VersionedTable(spark, f"file://{tmp_path}/t")
    rows = lambda v=None: sorted(tuple(r) for r in t.read(v).collect())
    v1 = t.write(spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string"), None)
    v2 = t.write(sinks.upsert(t.read(), spark.createDataFrame([(2, "B", False), (3, "c", False), (1, None, True)], "id int, x string, gone boolean"), ["id"], "gone"), v1)
    assert rows() == [(2, "B"), (3, "c")] and rows(v1) == [(1, "a"), (2, "b")]
    with pytest.raises(sinks.Conflict):
        t.write(t.read(), v1)
    # a writer that dies after its files and before the rename leaves the version as it was
    t.read().write.parquet(f"{tmp_path}/t/3-dead")
    assert t.version() == v2 and rows() == [(2, "B"), (3, "c")]
    # two writers from one version: the second cannot take the number
    t.commit("3-aaaa", v2)
    with pytest.raises(sinks.Conflict):
        t.commit("3-bbbb", v2)
    t2 = sinks.VersionedTable(spark, f"file://{tmp_path}/u")
    a = t2.write(t.read(v1), None)
    t2.write(t.read(v2), a)
    t2.rollback(a)
    assert sorted(tuple(r) for r in t2.read().collect()) == [(1, "a"), (2, "b")]


def test_a_writer_that_dies_after_its_claim_is_followed(spark, tmp_path, monkeypatch):
    """At each step: after the files, after the claim, before the rename. The next writer comes through once the claim is old."""
    path = f"file://{tmp_path}/t"
    t = sinks.VersionedTable(spark, path)
    one = spark.createDataFrame([(1, "a")], "id int, x string")
    v1 = t.write(one, None)
    kept = sinks.VersionedTable._claimed

    def die(self, number):
        raise KeyboardInterrupt

    monkeypatch.setattr(sinks.VersionedTable, "_claimed", die)
    with pytest.raises(KeyboardInterrupt):
        t.write(one, v1)
    monkeypatch.setattr(sinks.VersionedTable, "_claimed", kept)
    assert t.version() == v1
    with pytest.raises(sinks.Conflict):  # the claim may be that of a writer at work
        t.write(one, v1)
    late = sinks.VersionedTable(spark, path, stale=0)
    v2 = late.write(spark.createDataFrame([(2, "b")], "id int, x string"), v1)
    assert t.version() == v2 and [tuple(r) for r in t.read().collect()] == [(2, "b")]


def test_other_rows_than_were_written_are_told(spark):
    a = spark.createDataFrame([(1, "a")], "id int, x string")
    assert sinks.differences(a, a, "v") == ""
    assert "other rows" in sinks.differences(a, a.where("id = 2"), "v")
    assert "read back" in sinks.differences(a, a.select(F.raise_error(F.lit("gone")).cast("int").alias("id"), "x"), "v")


def test_upsert_leaves_absent_columns_alone(spark):
    old = spark.createDataFrame([(1, "a", "p")], "id int, x string, y string")
    out = sinks.upsert(old, spark.createDataFrame([(1, None), (2, "n")], "id int, x string"), ["id"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, None, "p"), (2, "n", None)]


def test_upsert_refuses_null_keys_and_two_changes_of_one(spark):
    old = spark.createDataFrame([(1, "a")], "id int, x string")
    for rows in ([(None, "n")], [(2, "n"), (2, "m")]):
        with pytest.raises(ValueError, match="null or changed twice"):
            sinks.upsert(old, spark.createDataFrame(rows, "id int, x string"), ["id"])


def test_an_empty_version_and_a_folder_that_is_there(spark, tmp_path):
    t = sinks.VersionedTable(spark, f"file://{tmp_path}/t")
    v1 = t.write(spark.createDataFrame([], "id int, x array<string>"), None)
    assert t.version() == v1 and t.read().count() == 0
    (tmp_path / "t" / "_current" / "2" / "2-other").mkdir(parents=True)  # a store that puts the folder inside another's
    with pytest.raises((sinks.Conflict, StopIteration)):
        t.write(t.read(), v1)


def test_schema_patch(spark):
    df = spark.createDataFrame([(1,)], "id int")
    want = T.StructType.fromDDL("id int, at timestamp")
    assert sinks.migrate(df, want, True).columns == ["id", "at"]
    with pytest.raises(PermissionError):
        sinks.migrate(df, want, False)
    with pytest.raises(ValueError):
        sinks.migrate(df, T.StructType.fromDDL("id string"), True)


def test_seal_ignores_order_and_tells_repeats(spark):
    a, b, c = (spark.createDataFrame(x, "id int, x string") for x in ([(1, "a"), (2, "b")], [(2, "b"), (1, "a")], [(1, "a"), (2, "b"), (2, "b")]))
    assert sinks.seal(a, ["id", "x"]) == sinks.seal(b, ["id", "x"]) != sinks.seal(c, ["id", "x"])


def test_seal_tells_a_value_that_moved_to_another_column(spark):
    ddl, other = "x string, y string, a array<string>", ["p", None]
    seals = {sinks.seal(spark.createDataFrame([row], ddl), ["x", "y", "a"]) for row in ((None, "v", other), ("v", None, other), (None, "v", other[::-1]), ("", "v", other))}
    assert len(seals) == 4


def test_observe_confirm_apply_noop(spark):
    """A changed body is held in the first run, applied in the second, and gives no action after that."""
    item = lambda h: spark.createDataFrame([("s", 1, "t", h)], "source string, item_id long, title string, body_hash string")
    kinds = lambda new, old, seen: [(r.kind, r.reason) for r in changes.mutation_plan(new, old, seen, []).collect()]
    old, new = item("h1"), item("h2")
    assert kinds(new, old.limit(0), new.limit(0)) == [("create", "absent")]
    assert kinds(new, old, new.limit(0)) == [("conflict", "unconfirmed_change")]
    assert kinds(new, old, new) == [("replace_body", "body_hash")]
    assert kinds(new, new, new.limit(0)) == [("noop", "equal")]
    assert [r.kind for r in changes.mutation_plan(new, old, new, ["s"]).collect()] == ["conflict"]
    both = new.withColumn("title", F.lit("u"))
    assert sorted(kinds(both, old, both)) == [("replace_body", "body_hash"), ("update_properties", "title")]


@pytest.mark.parametrize("run, logical, age, want", [("r1", "l1", 0, True), ("r1", "l1", 10_800, True), ("r1", "l1", 10_801, False), ("r0", "l1", 5, False), ("r1", "l2", 5, False), (None, "l1", 5, False), ("r1", "l1", -1, False)])
def test_consecutive_runs(spark, run, logical, age, want):
    t = lambda n: F.timestamp_seconds(F.lit(n))
    got = changes.consecutive(F.lit(run).cast("string"), F.lit("r1"), F.lit(logical), F.lit("l1"), F.lit("l2"), t(1_000_000 - age), t(1_000_000))
    assert spark.range(1).select(got).first()[0] is want
    same = changes.consecutive(F.lit("r1"), F.lit("r1"), F.lit("l1"), F.lit("l1"), F.lit("l1"), t(0), t(1))
    assert spark.range(1).select(same).first()[0] is False  # a retry of the same logical run never confirms


@pytest.mark.parametrize("pinned, lost, blocked", [(30, 21, True), (5, 3, True), (4, 4, False), (100, 20, False), (10, 5, False)])
def test_pinned_guard(spark, pinned, lost, blocked):
    dest = spark.range(pinned).select(F.lit("s").alias("source"), F.col("id").alias("item_id"))
    rows = changes.missing_pinned(dest, dest.where(F.col("item_id") >= lost)).collect()
    assert len(rows) == lost and {r.blocked for r in rows} == {blocked}


@pytest.mark.parametrize("days, since, want", [(7.99, 3_599, False), (7.99, 3_600, True), (8, 86_399, False), (8, 86_400, True), (31, 604_799, False), (31, 604_800, True)])
def test_refresh_tiers(spark, days, since, want):
    now = 2_000_000_000
    t = lambda n: F.timestamp_seconds(F.lit(int(n)))
    due = states.refresh_due(F.lit("1"), t(now - days * 86_400), F.lit(False), t(now - since), F.lit(None).cast("timestamp"), t(now))
    assert spark.range(1).select(due).first()[0] is want


def test_fold_keeps_first_sighting_and_drops_only_on_full(spark):
    ddl = "source string, item string, fingerprint string, published_at timestamp, first_seen_at timestamp, last_detail_at timestamp"
    d = lambda n: dt.datetime(2024, 1, n)
    state = spark.createDataFrame([("s", "1", "a", None, d(1), d(2)), ("s", "2", "b", None, d(1), None)], ddl)
    seen = spark.createDataFrame([("s", "1", "A", d(3), d(5), None), ("s", "3", "c", None, d(5), d(5))], ddl)
    key = ["source", "item"]
    out = {r.item: r for r in states.fold_observations(state, seen, key).collect()}
    assert set(out) == {"1", "2", "3"} and (out["1"].fingerprint, out["1"].first_seen_at, out["1"].last_detail_at) == ("A", d(1), d(2))
    assert {r.item for r in states.fold_observations(state, seen, key, full=True).collect()} == {"1", "3"}


def test_global_code_stops_all_sources(spark):
    results = spark.createDataFrame([("a", True), ("b", True), ("c", False)], "source string, write_safe boolean")
    issue = lambda rows: spark.createDataFrame(rows, "source string, code string, fatal boolean")
    safe = lambda rows: sorted(r.source for r in validation.safe_sources(results, issue(rows)).collect())
    assert safe([]) == ["a", "b"] and safe([("a", "incomplete_item", True)]) == ["b"] and safe([("a", "duplicate_source", True)]) == []
    assert safe([("a", "atomic_snapshot_unavailable", False)]) == ["a", "b"]


def test_run_control():
    now = [0.0]
    run = control.RunControl(seconds=1, reserve=1, clock=lambda: now[0])
    assert (run.seconds, run.reserve) == (60, 60)
    run = control.RunControl(clock=lambda: now[0])
    now[0] = 899
    run.check(writes=True)
    now[0] = 901
    run.check()
    with pytest.raises(control.RunStopped):
        run.check(writes=True)
    now[0] = 1_200
    with pytest.raises(control.RunStopped):
        run.check()
    assert control.may_write(False, True, False) and not control.may_write(True, True, False) and not control.may_write(False, True, True, True)


def test_one_writer(tmp_path):
    with control.exclusive(f"{tmp_path}/lock"):
        with pytest.raises(control.RunStopped), control.exclusive(f"{tmp_path}/lock"):
            pass
    with control.exclusive(f"{tmp_path}/lock"):
        assert os.stat(f"{tmp_path}/lock").st_mode & 0o777 == 0o600
    os.symlink(f"{tmp_path}/lock", f"{tmp_path}/link")
    with pytest.raises(OSError), control.exclusive(f"{tmp_path}/link"):
        pass


def test_stream_of_observations(spark, tmp_path):
    from tidemark.streaming.observations import first_within, observe

    ddl = "source string, item string, run_no long, logical_id string, fingerprint string"
    runs = [[("s", "1", 1, "l1", "a"), ("s", "2", 1, "l1", "x")], [("s", "1", 2, "l2", "b"), ("s", "2", 2, "l2", "y")], [("s", "1", 3, "l3", "b"), ("s", "2", 3, "l2", "y")]]
    for i, r in enumerate(runs):
        spark.createDataFrame(r, ddl).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        q = observe(spark.readStream.schema(ddl).parquet(f"{tmp_path}/in")).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(f"{tmp_path}/out")
        q.awaitTermination()
    got = {(r.item, r.run_no): r.status for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert [got["1", n] for n in (1, 2, 3)] == ["new", "changed", "confirmed"]
    assert [got["2", n] for n in (1, 2, 3)] == ["new", "changed", "changed"]  # the same logical run again
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 1))], "k long, at timestamp_ntz").write.parquet(f"{tmp_path}/e")
    q = first_within(spark.readStream.schema("k long, at timestamp_ntz").parquet(f"{tmp_path}/e"), ["k"], "at", "1 hour").writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp2").trigger(availableNow=True).start(f"{tmp_path}/o2")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/o2").count() == 2


def test_runs_end_to_end(spark, tmp_path):
    """Create, hold, a retry of the same logical run, apply, no-op; a dry run writes nothing."""
    from tidemark.runs import Workspace, run

    space, limits = Workspace(spark, f"file://{tmp_path}/w"), control.RunControl(clock=lambda: 0)
    item = lambda h: spark.createDataFrame([("s", 1, "t", h), ("s", 2, "u", "k")], "source string, item_id long, title string, body_hash string")
    go = lambda h, r, l, m, **k: sorted((x.item_id, x.kind, x.reason) for x in run(space, item(h), r, l, f"2024-01-01 00:{m:02d}:00", limits, **k).collect())
    assert go("a", "r0", "l0", 0, dry_run=True) == [(1, "create", "absent"), (2, "create", "absent")] and space.table("dest").version() is None
    assert go("a", "r1", "l1", 1) == [(1, "create", "absent"), (2, "create", "absent")]
    assert go("b", "r2", "l2", 2) == [(1, "conflict", "unconfirmed_change"), (2, "noop", "equal")]
    assert go("b", "r3", "l2", 3) == [(1, "conflict", "unconfirmed_change"), (2, "noop", "equal")]
    assert go("b", "r4", "l4", 4) == [(1, "replace_body", "body_hash"), (2, "noop", "equal")]
    assert go("b", "r5", "l5", 5) == [(1, "noop", "equal"), (2, "noop", "equal")]
    assert {r.item_id: r.body_hash for r in space.table("dest").read().collect()} == {1: "b", 2: "k"}
    assert space.table("runs").read().count() == 5
    assert {r.first_seen_at for r in space.table("state").read().collect()} == {dt.datetime(2024, 1, 1, 0, 1)}


def test_three_runs_read_the_texts_once(spark, sf, monkeypatch):
    from tidemark.plans import runs as R

    seen = []
    monkeypatch.setattr(R, "run", lambda space, items, *args, **more: seen.append(items))
    R._runs(spark, sf)
    assert len(seen) == 4
    assert not any("parquet" in x._jdf.queryExecution().optimizedPlan().toString() for x in seen)

"""Rules of paged scans against plain walks."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import scans


@pytest.mark.parametrize("block", [2, 3, 7, 4_096])
def test_runs_of_good_pages_equal_a_walk(spark, block):
    r = random.Random(block)
    rows = [(s, p, r.random() < (0.3, 0.8, 0.97, 1.0)[i]) for i, s in enumerate(("a", "b", "c", "d")) for p in r.sample(range(400), 150)]
    want, run = {}, {}
    for s, p, good in sorted(rows):
        run[s] = run.get(s, 0) + 1 if good else 0
        want[s, p] = run[s]
    df = spark.createDataFrame([(s, p, int(g), int(not g)) for s, p, g in rows], "source string, page long, known int, unknown int").repartition(3)
    got = {(x.source, x.page): x.overlap for x in scans.checkpoint_overlap(df, "source", "page", block).collect()}
    assert got == want


def test_no_sort_is_of_a_source_alone(spark):
    df = spark.createDataFrame([], "source string, page long, known int, unknown int")
    plan = scans.checkpoint_overlap(df, "source", "page")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and sum("[_over" not in w.split("windowspecdefinition")[0] and "_block" not in w for w in windows) <= 2  # over blocks of blocks only


# whole scans of paged lists


def notice(i, **more):
    return {"pkId": str(i), "title": f"t{i}", "regDate": "20240101", "isTop": "N"} | more


def board(source, page, size):
    """Lists for tests: by name of the source."""
    ids = {"long": range(1, 24), "none": (), "open": range(1, 11), "flat": range(1, 24), "moved": range(1, 24)}.get(source, range(1, 24))
    rows = [notice(i) for i in ids]
    if source == "long":
        rows[0]["isTop"] = "Y"
    at = rows[(page - 1) * size : page * size]
    out = {"rows": at, "total": len(rows), "has_more": page * size < len(rows), "page": page}
    if source == "open":
        out |= {"has_more": None}
    if source == "flat" and page == 3:
        out["rows"] = rows[:size]
    if source == "echo" and page == 2:
        out["page"] = 1
    if source == "down" and page == 4:
        raise ValueError("no answer")
    if source == "twice" and page == 4:
        out["rows"] = [notice(2), *at[1:]]
    if source == "bare" and page == 2:
        out["rows"] = [notice("x"), *at[1:]]
    if source == "less" and page == 3:
        out["total"] = 22
    return out


def scanned(spark, sources, known=(), resume=(), **more):
    from tidemark.operators import paged
    from tidemark.sources import board as B

    B.register(spark)
    pages = spark.read.format("board_pages").option("sources", ",".join(sources)).option("transport", "tests.test_scans:board").option("pageSize", "5").option("pages", "8").option("readings", "2").load()
    pages = spark.createDataFrame(pages.collect(), pages.schema)
    result, rows = paged.scan(pages, B.list_rows(pages), spark.createDataFrame(list(known), "source string, item_id string"), spark.createDataFrame(list(resume), "source string, resume_page long, anchors array<string>"), size=5, **more)
    return {r.source: r for r in result.collect()}, sorted((r.source, r.page_no, r.pos, r.item_id, r.read) for r in rows.collect())


def test_every_end_of_a_scan(spark):
    sources = ["long", "none", "open", "flat", "echo", "down", "twice", "bare", "less"]
    got, rows = scanned(spark, sources)
    told = {s: (r.status, r.reason, r.error, r.pages_scanned, r.observed) for s, r in got.items()}
    assert told == {
        "long": ("success", "backfill_window", None, 5, 23), "none": ("confirmed_empty", "natural_end", None, 1, 0), "open": ("partial", "page_error", "empty_unverified:3", 3, 10),
        "flat": ("partial", "page_error", "repeated_page:3", 3, 10), "echo": ("partial", "page_error", "page_echo:2", 1, 5), "down": ("partial", "page_error", "page_error:4", 3, 15),
        "twice": ("partial", "page_error", "identity_collision:4", 4, 15), "bare": ("partial", "page_error", "entry_contract:2", 2, 5), "less": ("partial", "page_error", "total_changed:3", 3, 10),
    }
    assert [x[3] for x in rows if x[0] == "long" and not x[4]] == ["22", "23"] and (got["long"].resume_page, got["long"].anchors) == (5, ["21", "22", "23"])
    known = [("long", str(i)) for i in range(4, 24)]
    got, rows = scanned(spark, ["long"], known)
    assert (got["long"].reason, got["long"].resume_page) == ("natural_end", None) and [x[3] for x in rows if x[4]] == ["1", "2", "3"]


def test_a_scan_has_a_cap_and_goes_on_from_its_anchors(spark):
    assert scanned(spark, ["long"], cap=3)[0]["long"].error == "hard_cap:4"
    assert scanned(spark, ["long"], resume=[("long", 4, ["18"])])[0]["long"].reason == "backfill_window"
    lost = scanned(spark, ["open"], resume=[("open", 3, ["99"])])[0]["open"]
    assert (lost.reason, lost.error) == ("resume_error", "resume_anchor_missing:3")


def test_a_second_reading_must_be_the_same(spark):
    from tidemark.operators import paged

    answer = [("s", i, p, True, p, 4, p < 2) for i in (1, 2) for p in (1, 2)]
    pages = spark.createDataFrame(answer, "source string, reading int, page_no long, ok boolean, echo long, total long, has_more boolean")
    row = lambda i, p, n, t: ("s", i, p, n % 2, str(n), t, "d", False)
    listed = [row(i, n // 2 + 1, n, "new" if (i, n) == (2, 3) else "t") for i in (1, 2) for n in range(4)]
    rows = spark.createDataFrame(listed, "source string, reading int, page_no long, pos int, item_id string, title string, date string, pinned boolean")
    none = spark.createDataFrame([], "source string, item_id string"), spark.createDataFrame([], "source string, resume_page long, anchors array<string>")
    got = paged.scan(pages, rows, *none, size=2)[0].first()
    assert (got.status, got.reason, got.error) == ("partial", "snapshot_changed", "snapshot_changed:2")
    assert paged.scan(pages, rows.where("title <> 'new'").unionByName(rows.where("title = 'new'").withColumn("title", F.lit("t"))), *none, size=2)[0].first().status == "success"


def test_line_items_are_ranked_once_for_a_scan(spark, sf):
    from tidemark.plans import paged

    for name in ("scan_results", "scan_rows", "scan_anchors"):
        plan = getattr(paged, name)(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert "InMemoryRelation" in plan, name


def test_ranges_of_pages_are_tasks_of_their_own(spark):
    from tidemark.sources import board as B

    B.register(spark)
    df = spark.read.format("board_pages").option("sources", "long,none").option("transport", "tests.test_scans:board").option("pageSize", "5").option("pages", "8").option("span", "2").load()
    assert df.rdd.getNumPartitions() == 8
    ids = [r.item_id for r in B.list_rows(df.where("source = 'long'")).orderBy("page_no", "pos").collect()]
    assert ids == [str(i) for i in range(1, 24)]


def test_a_stream_of_pages_resumes_by_page_and_anchors(spark, tmp_path):
    from tidemark.sources import board as B

    B.register(spark)

    def run(name):
        s = spark.readStream.format("board_pages").option("sources", "long,none").option("transport", "tests.test_scans:board").option("pageSize", "5").option("pages", "8").option("span", "2").load()
        q = s.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(processingTime="0 seconds").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()

    run("one")
    out = spark.read.schema(B.PAGES).parquet(f"{tmp_path}/out")
    seen = [(r.page_no, r.error) for r in out.where("source = 'long'").orderBy("page_no").collect()]
    assert seen == [(p, None) for p in range(1, 6)]
    run("again")  # nothing new after a restart
    assert spark.read.schema(B.PAGES).parquet(f"{tmp_path}/out").where("source = 'long'").count() == 5


def test_a_range_whose_anchors_have_moved_is_not_read():
    from tidemark.sources import board as B

    reader = B.PagesReader({"sources": "long", "transport": "tests.test_scans:board", "pageSize": "5"})
    assert [r[8] for r in reader.read(B.PageRange("long", 3, 4, ["99"]))] == ["resume_anchor_missing"]
    assert [r[2] for r in reader.read(B.PageRange("long", 3, 4, ["10"]))] == [3, 4]

"""A paged record list as a Spark data source.

`spark.read.format("board").option("sources", "a,b").option("transport", "package.module:function").load()` gives one row
per list row: source, page_no, pos, raw (JSON), total, has_more, error. Each source is a partition of its own. The
transport is any function (source, page_no, page_size) -> dict with `rows`, `total`, `has_more`; it is named, not passed,
so that executors can import it. Budgets stop a source that does not end, and say so in `error`.
"""

from __future__ import annotations

import importlib
import json
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "source string, page_no int, pos int, raw string, total bigint, has_more boolean, error string"
PAGE_SIZE, PAGE_CAP, SECONDS = 500, 100, 480


class SourcePartition(InputPartition):
    def __init__(self, source: str):
        self.source = source


class BoardReader(DataSourceReader):
    def __init__(self, options: dict):
        self.sources = [s for s in options.get("sources", "").split(",") if s]
        self.transport = options["transport"]
        self.size = min(500, max(1, int(options.get("pageSize", PAGE_SIZE))))
        self.pages = min(1000, max(1, int(options.get("pages", PAGE_CAP))))
        self.seconds = float(options.get("seconds", SECONDS))
        self.spacing = float(options.get("spacing", 0))

    def partitions(self):
        return [SourcePartition(s) for s in self.sources]

    def read(self, partition: SourcePartition):
        module, name = self.transport.split(":")
        fetch, source, until = getattr(importlib.import_module(module), name), partition.source, time.monotonic() + self.seconds
        for page in range(1, self.pages + 1):
            if time.monotonic() > until:
                yield source, page, None, None, None, None, "time_budget"
                return
            try:
                got = fetch(source, page, self.size)
                rows, total, more = got["rows"], int(got["total"]), bool(got["has_more"])
                if not isinstance(rows, list) or len(rows) > self.size or (more and not rows):
                    raise ValueError("rows do not fit the page")
            except (KeyError, TypeError, ValueError) as e:
                yield source, page, None, None, None, None, f"page_error: {e}"
                return
            for pos, row in enumerate(rows):
                yield source, page, pos, json.dumps(row, ensure_ascii=False, sort_keys=True), total, more, None
            if not more:
                return
            time.sleep(self.spacing)
        yield source, self.pages, None, None, None, None, "hard_cap"


class BoardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "board"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BoardReader:
        return BoardReader(self.options)


def register(spark) -> None:
    spark.dataSource.register(BoardSource)
    spark.dataSource.register(PagesSource)


PAGES = "source string, reading int, page_no bigint, ok boolean, echo bigint, total bigint, has_more boolean, rows array<string>, error string"
NEAR = 2  # pages around the one where an earlier scan stopped, in which its ids are looked for


def _fetcher(transport: str):
    module, name = transport.split(":")
    return getattr(importlib.import_module(module), name)


class PageRange(InputPartition):
    """Pages `first` to `last` of a source; after them, if asked, the same again. anchors: of the ids on page `first` or near
    it one at least must be among these, or nothing is read."""

    def __init__(self, source: str, first: int, last: int, anchors: list[str]):
        self.source, self.first, self.last, self.anchors = source, first, last, anchors


class _Pages:
    """What the batch and the stream share: the options, one answer as a row, and the reading of a range."""

    def __init__(self, options: dict):
        self.sources = [s for s in options.get("sources", "").split(",") if s]
        self.transport, self.key = options["transport"], options.get("key", "pkId")
        self.size = min(500, max(1, int(options.get("pageSize", PAGE_SIZE))))
        self.pages = min(1000, max(1, int(options.get("pages", PAGE_CAP))))
        self.span = max(1, int(options.get("span", self.pages)))
        self.readings = max(1, int(options.get("readings", 1)))

    def answer(self, source: str, reading: int, page: int) -> tuple:
        try:
            got = _fetcher(self.transport)(source, page, self.size)
            rows, more = got["rows"], got.get("has_more")
            if not isinstance(rows, list) or len(rows) > self.size:
                raise ValueError("rows do not fit the page")
            total = got.get("total")
            return source, reading, page, True, int(got.get("page", page)), None if total is None else int(total), None if more is None else bool(more), [json.dumps(r, ensure_ascii=False, sort_keys=True) for r in rows], None
        except (KeyError, TypeError, ValueError) as e:
            return source, reading, page, False, page, None, None, [], f"page_error: {e}"

    def ids(self, answer: tuple) -> list[str]:
        return sorted({str(x) for r in answer[7] if (x := json.loads(r).get(self.key)) is not None})

    def read(self, partition: PageRange):
        if partition.anchors:
            near = range(max(1, partition.first - 1 - NEAR), partition.first + NEAR)
            if not any(set(self.ids(self.answer(partition.source, 1, p))) & set(partition.anchors) for p in near):
                yield partition.source, 1, partition.first, False, partition.first, None, None, [], "resume_anchor_missing"
                return
        last = partition.last
        for reading in range(1, self.readings + 1):
            for page in range(partition.first, last + 1):
                row = self.answer(partition.source, reading, page)
                yield row
                if not row[3] or not row[7] or row[6] is False:  # a fault, an empty page or the end: read again up to here
                    last = page
                    break


class PagesReader(_Pages, DataSourceReader):
    """Ranges of `span` pages are tasks of their own, so a long list is not one task's work."""

    def partitions(self):
        return [PageRange(s, first, min(first + self.span - 1, self.pages), []) for s in self.sources for first in range(1, self.pages + 1, self.span)]


class PagesStream(_Pages, DataSourceStreamReader):
    """The offset has for each source the next page, the ids on the page before it, and whether the list has ended. A batch
    takes up to `span` pages of each; that the list has not moved meanwhile is told by the ids around the last page."""

    def initialOffset(self) -> dict:  # noqa: N802
        self.now = {s: {"page": 1, "anchors": [], "ended": False} for s in self.sources}
        return self.now

    def latestOffset(self) -> dict:  # noqa: N802
        """Asks for the last page of the next batch only, and where that is beyond the end for those before it."""
        after = {}
        for source, at in (getattr(self, "now", None) or self.initialOffset()).items():
            after[source] = at
            last = min(at["page"] + self.span - 1, self.pages)
            if at["ended"] or at["page"] > self.pages:
                continue
            for page in range(last, at["page"] - 1, -1):
                row = self.answer(source, 1, page)
                if row[7] or page == at["page"]:
                    after[source] = {"page": page + 1, "anchors": self.ids(row) or at["anchors"], "ended": page < last or not row[7] or row[6] is False}
                    break
        self.now = after
        return after

    def partitions(self, start: dict, end: dict):
        self.now = end
        return [PageRange(s, start[s]["page"], e["page"] - 1, start[s]["anchors"]) for s, e in end.items() if e["page"] > start[s]["page"]]


class PagesSource(DataSource):
    """`board_pages`: a row per answer (source, reading, page_no, ok, echo, total, has_more, rows as JSON, error), as
    `operators.paged.scan` wants it; in batch with `readings` passes over every range, as a stream with an offset by page."""

    @classmethod
    def name(cls) -> str:
        return "board_pages"

    def schema(self) -> str:
        return PAGES

    def reader(self, schema) -> PagesReader:
        return PagesReader(self.options)

    def streamReader(self, schema) -> PagesStream:  # noqa: N802
        return PagesStream(self.options)


def list_rows(pages: DataFrame, key: str = "pkId", title: str = "title", date: str = "regDate", pinned: str = "isTop") -> DataFrame:
    """The list rows of answered pages, with the fields that `operators.paged.scan` looks at."""
    rows = pages.where("ok").select("source", "reading", "page_no", F.posexplode("rows").alias("pos", "raw"))
    get = lambda k: F.get_json_object("raw", f"$.{k}")
    return rows.select("source", "reading", "page_no", F.col("pos").cast("bigint").alias("pos"), get(key).alias("item_id"), get(title).alias("title"), get(date).alias("date"), F.coalesce(F.upper(get(pinned)) == "Y", F.lit(False)).alias("pinned"))

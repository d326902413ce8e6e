"""The fold of reports as a stream: each source's state in Spark's state store, one row out for each report.

State variables: what is known of the source, the last observation of emptiness, and a map of missing items with their
counts, which are forgotten after a time. A timer tells when an open circuit closes. The rules are those of
`tidemark.operators.reports`, where a batch of reports gives the same rows. The session's state store must be RocksDB's
(`spark.sql.streaming.stateStore.providerClass`).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import reports as R

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NAMES = [x.split()[0] for x in R.STATE.split(", ")]
KEPT = ", ".join(x for x in R.STATE.split(", ")[1:])


class ReportFold(StatefulProcessor):
    def __init__(self, failures: int, cooldown: int, block_cooldown: int):
        self.failures, self.cooldown, self.block_cooldown = failures, cooldown, block_cooldown

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", KEPT)
        self.emptiness = handle.getValueState("emptiness", "run_no long, logical_id string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = dict(zip(NAMES[1:], self.state.get(), strict=True)) if self.state.exists() else dict.fromkeys(NAMES[1:]) | {"failures": 0, "empty_pending": False, "backfill_active": False}
        empty = tuple(self.emptiness.get()) if self.emptiness.exists() else None
        out = []
        for r in pd.concat(list(rows)).sort_values("run_no").astype(object).itertuples(index=False):
            r = {k: None if pd.isna(v) else v for k, v in r._asdict().items()}
            now, empty = self.after(now, empty, r)
            out.append((key[0], *(now[n] for n in NAMES[1:])))
        self.state.update(tuple(now[n] for n in NAMES[1:]))
        if empty is None:
            self.emptiness.clear()
        else:
            self.emptiness.update(empty)
        columns = pd.DataFrame(out, columns=NAMES)
        yield columns.astype({n: "boolean" if n in ("empty_pending", "backfill_active") else "Int64" for n in NAMES[1:]})

    def after(self, was: dict, empty: tuple | None, r: dict) -> tuple[dict, tuple | None]:
        """One report."""
        now, at, safe = was | {"run_no": int(r["run_no"]), "last_attempt_at": int(r["at"])}, int(r["at"]), bool(r["write_safe"])
        if safe:
            now |= {"failures": 0, "fallback_open_until": None, "source_open_until": None}
        elif r["method"] in R.FALLBACK:
            now["failures"] += 1
            if now["failures"] >= self.failures:
                now["fallback_open_until"] = at + self.cooldown
        if not safe and (r["method"] == "api_source_circuit_open" or r["category"] == "security_policy" and r["method"] not in R.CIRCUIT_OPEN):
            now["source_open_until"] = at + max(self.block_cooldown, min(R.LONGEST_WAIT, max(0, int(r["retry_after"] or 0))))
        if not (safe and r["applied"]):
            if r["termination"] == "resume_error":
                now["resume_page"] = None
            return now, empty
        now["last_success_at"], twice = at, False
        if r["status"] == "confirmed_empty":
            twice = empty is not None and empty[0] == r["run_no"] - 1 and (not r["logical_id"] or bool(empty[1]) and empty[1] != r["logical_id"])
            now |= {"empty_count": now["empty_count"] + 1 if twice else 1, "empty_pending": not twice}
            empty = (int(r["run_no"]), r["logical_id"])
        else:
            now |= {"empty_count": None, "empty_pending": False}
            empty = None
        if r["reconcile"] and r["covered"]:
            now |= {"backfill_active": False, "backfill_started_at": None, "resume_page": None}
            if r["status"] != "confirmed_empty" or twice:
                now |= {"last_item_count": int(r["n_items"]), "last_covered_at": at} | ({"last_full_at": at} if r["complete"] else {})
        elif r["termination"] == "backfill_window":
            page = r["resume_page"]
            now |= {"backfill_active": True, "backfill_started_at": now["backfill_started_at"] if now["backfill_active"] else at, "resume_page": None if page is None else int(page)}
        return now, empty

    def close(self) -> None:
        pass


class AbsenceCounts(StatefulProcessor):
    """The counts of what a source's last look missed. They are forgotten `ttl` seconds after the last look, by a timer."""

    def __init__(self, most: int, ttl: int):
        self.most, self.ttl = most, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "item string", "n long")
        self.look = handle.getValueState("look", "run_no long, logical_id string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out = []
        for r in pd.concat(list(rows)).sort_values("run_no").itertuples(index=False):
            was = tuple(self.look.get()) if self.look.exists() else None
            on = was is not None and was[0] == r.run_no - 1 and (not r.logical_id or bool(was[1]) and was[1] != r.logical_id)
            old = {k[0]: v[0] for k, v in self.counts.iterator()} if on else {}
            self.counts.clear()
            for item in r.missing:
                n = min(self.most, old.get(item, 0) + 1)
                self.counts.updateValue((item,), (n,))
                out.append((key[0], int(r.run_no), item, n))
            self.look.update((int(r.run_no), r.logical_id))
        if self.ttl:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + 1_000 * self.ttl)
        yield pd.DataFrame(out, columns=["source", "run_no", "item", "observations"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.counts.clear()
        self.look.clear()
        yield pd.DataFrame([], columns=["source", "run_no", "item", "observations"])

    def close(self) -> None:
        pass


def _with_store(stream: DataFrame) -> None:
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def fold_reports(stream: DataFrame, failures: int = R.FAILURES, cooldown: int = R.COOLDOWN, block_cooldown: int = R.BLOCK_COOLDOWN) -> DataFrame:
    """The state after each report, as `R.report_states` has it. Reports of a source must come in the order of their runs,
    as they do from the runs themselves."""
    _with_store(stream)
    return stream.groupBy("source").transformWithStateInPandas(ReportFold(failures, cooldown, block_cooldown), R.STATE, "Append", "None")


def count_absences(stream: DataFrame, most: int = R.MOST, ttl: int = 0) -> DataFrame:
    """stream(source, run_no, logical_id, missing: array of items): in how many runs in a row each was missing."""
    _with_store(stream)
    return stream.groupBy("source").transformWithStateInPandas(AbsenceCounts(most, ttl), "source string, run_no long, item string, observations long", "Append", "ProcessingTime" if ttl else "None")

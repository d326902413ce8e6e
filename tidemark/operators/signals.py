"""Signals of lasting failures, not repeated within a time.

A message signals if its key has not signalled, or not for `window` seconds. What counts is the last signal that was
delivered: between two of those no message signals, and after one that could not be delivered the next message signals
anew. So the delivered signals of a key are a chain, each the first delivered message at least `window` seconds after the one
before, and where the chain stands at a time depends on all that came before.

Messages of one key and second are one row. Rows are grouped by key and epoch, a span of some windows, so that no group
has more rows than its span has seconds, however frequent the key. Where a key has several epochs, the chain's way through
each is told for every place at which it may enter, as a few steps (from up to this time it leaves with that); the steps are
followed through a key's epochs, and every epoch is then done from the place of its entry.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .groups import starts, whole_groups

EPOCH = 16  # windows
NEVER = -(1 << 60)


def _chain(at: np.ndarray, group: np.ndarray, window: int) -> np.ndarray:
    """For every row the first of its group at least a window later, or itself if there is none. Rows are sorted."""
    wide = 2 * int(at.max(initial=0) - at.min(initial=0) + window + 1)
    line = at - at.min(initial=0) + group * wide
    following = np.searchsorted(line, line + window)
    own = np.minimum(following, len(at) - 1)
    return np.where((following < len(at)) & (group[own] == group), own, np.arange(len(at)))


def _steps(table: pa.Table, keys: list[str], window: int, epoch: int) -> pa.Table:
    """Messages by key and epoch: for an entry at up to `upto`, the time from which a message signals behind the epoch. An
    entry beyond the last step, as any into an epoch without a delivered message, stays as it is."""
    first = starts(table, [*keys, "epoch"])
    whole = np.repeat(np.arange(len(first)), np.diff([*first, len(table)]))
    told = np.flatnonzero(table.column("delivered").to_numpy(zero_copy_only=False))
    at, group = table.column("t").to_numpy()[told], whole[told]
    onward = _chain(at, group, window)
    while len(at) and (onward[onward] != onward).any():
        onward = onward[onward]
    leaves = at[onward] + window
    begins = table.column("epoch").to_numpy()[first] * epoch + window  # no entry lies beyond
    inside = np.concatenate([[False], group[1:] == group[:-1]])[: len(at)]
    before = np.where(inside, np.concatenate([[NEVER], at[:-1]])[: len(at)], NEVER)
    entry = before < begins[group]  # each row that is the first at or after some entry
    same = np.zeros(len(at), bool)
    same[:-1] = entry[1:] & (leaves[1:] == leaves[:-1]) & (group[1:] == group[:-1])
    kept = np.flatnonzero(entry & ~same)
    offsets = np.searchsorted(group[kept], np.arange(len(first) + 1)).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x[kept])) for x in (at, leaves)]
    return pa.table([*(table.column(c).combine_chunks().take(pa.array(first)) for c in (*keys, "epoch")), *lists], names=[*keys, "epoch", "upto", "leaves"])


def _entries(keys: list[str]):
    def run(epochs: pa.Table) -> pa.Table:
        """All epochs of one key: from when on a message signals, at the beginning of each."""
        epochs, now, found = epochs.sort_by("epoch"), NEVER, []
        for upto, leaves in zip(epochs.column("upto").to_pylist(), epochs.column("leaves").to_pylist(), strict=True):
            found.append(now)
            step = int(np.searchsorted(upto, now))
            now = leaves[step] if step < len(upto) else now
        return pa.table([*(epochs.column(c) for c in (*keys, "epoch")), pa.array(found, pa.int64())], names=[*keys, "epoch", "since"])

    return run


def _mark(table: pa.Table, keys: list[str], window: int) -> np.ndarray:
    """Whether each row signals, from `since` of its group on."""
    first, at = starts(table, [*keys, "epoch"]), table.column("t").to_numpy()
    group = np.repeat(np.arange(len(first)), np.diff([*first, len(at)]))
    since = table.column("since").to_numpy()
    told = np.flatnonzero(table.column("delivered").to_numpy(zero_copy_only=False))
    anchor = np.zeros(len(at), bool)
    if len(told):
        onward = _chain(at[told], group[told], window)
        fit = at[told] >= since[told]
        now = np.flatnonzero(fit & ~np.concatenate([[False], fit[:-1] & (group[told][1:] == group[told][:-1])]))  # of each group
        while len(now):
            anchor[told[now]] = True
            now = onward[now][onward[now] != now]
    last = np.maximum.accumulate(np.where(anchor, np.arange(len(at)), -1))
    last = np.concatenate([[-1], last[:-1]])  # the anchor before each row
    from_when = np.where(last >= first[group], at[np.maximum(last, 0)] + window, since)
    return at >= from_when


def repeat_signals(messages: DataFrame, keys: list[str], at: str, window: int, delivered: str | None = None, windows: int = EPOCH) -> DataFrame:
    """messages: keys, at (whole seconds), and perhaps a boolean whether a signal at that message gets through (all do
    otherwise). One row per key and second: keys, t, n, delivered, signals."""
    epoch = windows * window
    got = F.coalesce(F.col(delivered), F.lit(False)) if delivered else F.lit(True)
    rows = messages.select(*keys, F.col(at).cast("long").alias("t"), got.alias("delivered")).groupBy(*keys, "t").agg(F.count(F.lit(1)).alias("n"), F.bool_or("delivered").alias("delivered"))
    rows = rows.withColumn("epoch", F.floor(F.col("t") / epoch).cast("long"))
    both = [*keys, "epoch"]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*both).schema)

    def steps(batches):
        for table in whole_groups(batches, both):
            yield from _steps(table, keys, window, epoch).to_batches()

    def mark(batches):
        for table in whole_groups(batches, both):
            signals = pa.array(_mark(table, keys, window))
            yield from table.select([*keys, "t", "n", "delivered"]).append_column("signals", signals).to_batches()

    alike = lambda columns: reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    span = rows.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.min("epoch").alias("_low"), F.max("epoch").alias("_high")).where("_low < _high")
    long = rows.join(span, alike(keys), "left_semi").select(*both, "t", "delivered").repartition(*both).sortWithinPartitions(*both, "t")
    ways = long.mapInArrow(steps, f"{types}, upto array<long>, leaves array<long>")
    entries = ways.groupBy(*keys).applyInArrow(_entries(keys), f"{types}, since long").select(*(F.col(c).alias(f"_{c}") for c in both), "since")
    begun = rows.join(entries, alike(both), "left").select(*both, "t", "n", "delivered", F.coalesce("since", F.lit(NEVER)).alias("since"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema)
    marked = begun.repartition(*both).sortWithinPartitions(*both, "t")
    return marked.mapInArrow(mark, f"{types}, t long, n long, delivered boolean, signals boolean")

"""The fold of observations as a stream: state per (source, item) in Spark's state store, changes and confirmations out.

An extension: the reference works in runs, whose rules these are. A change of a record's fingerprint is told as `changed`
when first seen, and as `confirmed` when the next run, of another logical id, sees the same again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "source string, item string, run_no bigint, fingerprint string, status string"
STATE = "fingerprint string, candidate string, candidate_run bigint, candidate_logical string"


def _fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held, cand, cand_run, cand_logical = state.get if state.exists else (None, None, -1, None)
    out = []
    rows = pd.concat(list(frames)).sort_values(["run_no", "fingerprint"])
    for run, logical, fp in rows[["run_no", "logical_id", "fingerprint"]].itertuples(index=False):
        if held is None:
            held, status = fp, "new"
        elif fp == held:
            cand, status = None, "same"
        elif fp == cand and run == cand_run + 1 and logical != cand_logical:
            held, cand, status = fp, None, "confirmed"
        else:
            cand, cand_run, cand_logical, status = fp, run, logical, "changed"
        out.append((*key, run, fp, status))
    state.update((held, cand, int(cand_run), cand_logical))
    yield pd.DataFrame(out, columns=[x.split()[0] for x in OUT.split(", ")])


def observe(stream: DataFrame) -> DataFrame:
    """stream(source, item, run_no, logical_id, fingerprint)."""
    return stream.groupBy("source", "item").applyInPandasWithState(_fold, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


def first_within(stream: DataFrame, keys: list[str], at: str, delay: str) -> DataFrame:
    """The first row of each key; keys are forgotten once the watermark has passed them."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)

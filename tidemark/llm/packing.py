"""Best-fit packing (operator 9) by minimum bin slack.

Documents become pieces of at most `size` tokens. What decides the packing is how many pieces of each length there are:
a table of at most `size` rows. For each bin the longest piece left is fixed, and a bitset subset-sum over the lengths
left finds the fullest combination with it; that combination is taken as often as the counts allow. Every step leaves
some length too scarce for its share, so the plan has a few thousand lines at most, whatever the number of documents.
Pieces then find their places from their rank among the pieces of their length, which is summed over salted buckets.

Cases: a null text is empty and has its end id alone; only longer documents are cut, the first piece being the shorter;
repeated rows and ids are kept; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, give_back, parts, two
from .tokens import CHUNKS, WordEncoder


def cut_pieces(docs: DataFrame, path: str, end_id: int = 0, size: int = 2048, id_col: str = "doc_id", text_col: str = "text", cached: int = CHUNKS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32."""

    def run(batches):
        coder, end = WordEncoder.of(path, cached), end_id.to_bytes(2, "little")
        for b in batches:
            rows: list[tuple] = []
            for d, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ids = np.frombuffer(coder.packed(text.as_py()) + end, "<u2").astype("<u4")
                at = 0
                for p in range(-(-len(ids) // size)):
                    n = (len(ids) - 1) % size + 1 if p == 0 else size
                    rows.append((d, p, at, n, zlib.crc32(ids[at : at + n].tobytes())))
                    at += n
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])
        coder.forget()
        give_back()

    return two(docs, id_col, text_col).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of at most counts[l] pieces of each length l that fills the room best."""
    reach, full, steps = 1, (1 << (room + 1)) - 1, []
    for n in lengths:
        if n > room:
            continue
        left, take = min(counts[n], room // n), 1
        while left > 0:
            take = min(take, left)
            steps.append((n, take, reach))
            reach |= (reach << (n * take)) & full
            left, take = left - take, take * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for n, take, before in reversed(steps):
        if not before >> total & 1:
            total -= n * take
            chosen[n] = chosen.get(n, 0) + take
    return chosen


def plan_bins(counts: dict[int, int], size: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Lines (length, first rank, pieces a bin, first bin, offset in the bin), and the number of bins."""
    counts = {n: c for n, c in counts.items() if c}
    lengths, used, lines, bins = sorted(counts, reverse=True), dict.fromkeys(counts, 0), [], 0
    while lengths:
        big = lengths[0]
        counts[big] -= 1
        chosen = fullest(lengths, counts, size - big)
        counts[big] += 1
        chosen[big] = chosen.get(big, 0) + 1
        times, at = min(counts[n] // k for n, k in chosen.items()), 0
        for n, k in sorted(chosen.items(), reverse=True):
            lines.append((n, used[n], k, bins, at))
            at += n * k
            used[n] += k * times
            counts[n] -= k * times
        bins += times
        lengths = [n for n in lengths if counts[n]]
    return lines, bins


def pack(pieces: DataFrame, size: int = 2048) -> DataFrame:
    """pieces with a column length (1 to size): adds sequence_id and offset."""
    spark = pieces.sparkSession
    scratch, names = Scratch(spark, "packing"), pieces.columns
    rows = scratch.table(pieces.withColumn("_uid", F.monotonically_increasing_id()), "pieces")
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("_uid"), F.lit(4 * parts(spark))).cast("int"))
    some = scratch.table(rows.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("n")), "counts")
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = scratch.table(some.select("length", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")), "before")
    counts = {int(n): int(c) for n, c in some.groupBy("length").agg(F.sum("n")).collect()}  # at most `size` rows
    lines, _ = plan_bins(counts, size)
    by_length: dict[int, np.ndarray] = {}
    for n, *rest in lines:
        by_length.setdefault(n, []).append(rest)
    plan = spark.sparkContext.broadcast({n: np.array(x, np.int64).T for n, x in by_length.items()})
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("_uid")))
    ranked = ranked.join(scratch.shuffled(before), ["length", "_bucket"]).withColumn("_rank", F.col("_before") + F.col("_rank") - 1).select(*names, "_rank")

    def place(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("_rank").to_numpy()
            seq, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                first, k, bins, at = plan.value[int(n)]
                line = np.searchsorted(first, rank[own], "right") - 1
                nth = rank[own] - first[line]
                seq[own], offset[own] = bins[line] + nth // k[line], at[line] + nth % k[line] * n
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in names), pa.array(seq), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long")


def best_fit_packing(docs: DataFrame, path: str, size: int = 2048, id_col: str = "doc_id", text_col: str = "text", cached: int = CHUNKS) -> DataFrame:
    """cached: entries in the largest of the encoder's caches; fewer take less memory and more time."""
    return pack(cut_pieces(docs, path, 0, size, id_col, text_col, cached), size)

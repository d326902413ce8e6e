"""Exact dedup (operator 8): Golomb-coded fingerprint exchange.

Every input partition sorts its distinct 48-bit fingerprints and sends each owner (a range of fingerprints) one
Golomb-Rice coded message. The owner answers with a bitmap: which of them another partition has too. A partition
flags those and its own repeats as suspects. The documents are then read again: a bitmap of the suspects' text hashes, of
fixed size, keeps the others' texts where they are; suspects' texts are shuffled, and equality is settled on their bytes
by grouping. Where there are so many suspects that the bitmap would tell nothing, all texts take part in that join.

Cases: a null text counts as empty; texts of white space alone are equal to the empty one; of equal texts the row with
the most code points stays, then the smallest id (a null id sorts first); repeated rows form a group like any other; an
empty table gives an empty result; other columns are not looked at.
A row is known by its id and a hash of its text when the documents are read again for the suspects' texts; rows alike
in both are repeats, and all of them have the same answers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BITS, Scratch, bitmap, owners_of, possible, two

SPACE = b" \t\n\x0b\x0c\r"
FP_BITS = 48
SENT = "doc_id long, text_hash long, n_chars long, fp long, sha binary, pid int, owner int, n int, payload binary"


def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted distinct non-negative values as: count, Rice parameter, quotients in unary, remainders of fixed width."""
    gaps = np.diff(values, prepend=values.dtype.type(0)).astype(np.uint64)
    k = max(0, int(np.log2(max(1.0, float(gaps.mean())))))
    ends = np.cumsum((gaps >> np.uint64(k)).astype(np.int64) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    rest = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return len(values).to_bytes(4, "little") + bytes([k]) + len(unary).to_bytes(8, "little") + np.packbits(unary).tobytes() + np.packbits(rest.ravel()).tobytes()


def golomb_decode(blob: bytes) -> np.ndarray:
    n, k, m = int.from_bytes(blob[:4], "little"), blob[4], int.from_bytes(blob[5:13], "little")
    cut = 13 + (m + 7) // 8
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, cut - 13, 13), count=m))
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    if k:
        rest = np.unpackbits(np.frombuffer(blob, np.uint8, offset=cut), count=n * k).reshape(n, k)
        gaps += (rest.astype(np.uint64) << np.arange(k, dtype=np.uint64)).sum(1, dtype=np.uint64)
    return np.cumsum(gaps).astype(np.int64)


def owner_of(fp: np.ndarray, owners: int) -> np.ndarray:
    return (fp * owners) >> FP_BITS if owners < 1 << 14 else ((fp >> 16) * owners) >> (FP_BITS - 16)


def _send(owners: int):
    def run(batches):
        pid, seen = TaskContext.get().partitionId(), [np.empty(0, np.int64)]
        for b in (whole.slice(i, 1024) for whole in batches for i in range(0, len(whole), 1024)):
            shas = [hashlib.sha256(x.translate(None, SPACE)).digest() for x in b.column("raw").to_pylist()]
            fp = np.frombuffer(b"".join(x[:8] for x in shas), ">u8") >> np.uint64(64 - FP_BITS)
            seen.append(np.unique(fp.astype(np.int64)))
            n = len(shas)
            none = pa.nulls(n, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), b.column("n_chars"), pa.array(fp.astype(np.int64)), pa.array(shas, pa.binary()), pa.array(np.full(n, pid, np.int32)), none, none, pa.nulls(n, pa.binary())], names=[x.split()[0] for x in SENT.split(", ")])
        own = np.unique(np.concatenate(seen))
        cuts = np.searchsorted(owner_of(own, owners), np.arange(owners + 1))
        for o in np.flatnonzero(np.diff(cuts)):
            part = own[cuts[o] : cuts[o + 1]]
            yield pa.RecordBatch.from_pylist([{"pid": pid, "owner": int(o), "n": len(part), "payload": golomb_encode(part)}], schema=_schema(SENT))

    return run


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64()}
    return pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in ddl.split(", ")])


def _answer(group: pa.Table) -> pa.Table:
    """An owner: which fingerprints of each message stand in another message too."""
    told = [golomb_decode(x) for x in group.column("payload").to_pylist()]
    every, times = np.unique(np.concatenate(told), return_counts=True)
    twice = every[times > 1]
    bits = [np.packbits(np.isin(x, twice, assume_unique=True)).tobytes() for x in told]
    return pa.table({"pid": group.column("pid"), "owner": group.column("owner"), "n": group.column("n"), "bits": pa.array(bits, pa.binary())})


def _flag(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """A partition: its own repeats, and what the owners have named."""
    fp = docs.column("fp").to_numpy()
    own, back, times = np.unique(fp, return_inverse=True, return_counts=True)
    answers = answers.sort_by("owner")
    bits = [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(answers.column("bits").to_pylist(), answers.column("n").to_pylist(), strict=True)]
    named = np.concatenate([np.empty(0, np.uint8), *bits]).astype(bool) | (times > 1)
    return docs.select(["doc_id", "text_hash", "n_chars", "fp", "sha"]).append_column("suspect", pa.array(named[back] if len(back) else np.empty(0, bool)))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owners: int | None = None, bits: int = BITS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the text without white space), text_hash, XXH64
    of the text as it is, and stays: kept, and of rows that share the id that stays, with the text that stays."""
    spark = docs.sparkSession
    scratch, owners = Scratch(spark, "exact"), owners or owners_of(docs)
    rows = two(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    raw = rows.select("doc_id", "text_hash", F.length("text").cast("long").alias("n_chars"), F.col("text").cast("binary").alias("raw"))
    sent = scratch.table(raw.mapInArrow(_send(owners), SENT), "sent")
    answers = sent.where("payload is not null").select("pid", "owner", "n", "payload").groupBy("owner").applyInArrow(_answer, "pid int, owner int, n int, bits binary")
    plain = sent.where("payload is null").select("doc_id", "text_hash", "n_chars", "fp", "sha", "pid")
    flagged = scratch.table(plain.groupBy("pid").cogroup(answers.groupBy("pid")).applyInArrow(_flag, "doc_id long, text_hash long, n_chars long, fp long, sha binary, suspect boolean"), "flagged")
    suspects = flagged.where("suspect")
    bare = F.translate("text", SPACE.decode(), "").alias("bare")
    told = suspects.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "n_chars", "fp", "sha").distinct()
    likely = rows.where(possible(spark, bitmap(suspects.select("text_hash"), bits), F.col("text_hash")))
    texts = likely.join(scratch.shuffled(told), likely.doc_id.eqNullSafe(told.id) & (likely.text_hash == told.hash)).select("doc_id", "text_hash", "n_chars", "fp", "sha", bare)
    groups = texts.groupBy("fp", "bare").agg(F.min(F.struct((-F.col("n_chars")).alias("x"), "doc_id", "text_hash")).alias("best"), F.count(F.lit(1)).alias("group_size"), F.min("sha").alias("sha"))
    groups = scratch.table(groups.select("fp", "sha", F.col("best.doc_id").alias("keep_id"), F.col("best.text_hash").alias("keep_hash"), "group_size"), "groups")
    hexed = F.lower(F.hex("sha")).alias("text_sha256")
    of_group = suspects.join(scratch.shuffled(groups), ["fp", "sha"]).select("doc_id", "keep_id", "group_size", hexed, "text_hash", "keep_hash")
    alone = flagged.where("not suspect").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), hexed, "text_hash", F.col("text_hash").alias("keep_hash"))
    both = of_group.unionByName(alone)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return both.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", "text_hash", (kept & (F.col("text_hash") == F.col("keep_hash"))).alias("stays"))

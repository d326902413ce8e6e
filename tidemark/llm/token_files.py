"""Token ids in files of directly addressable codes (operator 3).

A file holds the ids of whole documents in ascending id order. Ids are split into chunks of eight bits by level: level 0
has the low chunk of every id, level 1 the next chunk of those that need one, and so on. A bitmap on each level marks the
ids that go on, and a directory with the count of marks before every 64 bits turns a position on one level into that on
the next. So any token or range is read from its own bytes, with no block to decode.

Layout (little-endian): `DAC2`, documents u32, levels u32, documents of null id u32 (they come first), then document ids
i64 and end positions u64, then for each level: count u64, chunks u8 x count, marks u64 x ceil(count/64), directory u32 x
(ceil(count/64)+1). Files are the `blob` values of a Parquet table written by Spark, without compression, so that any store
Spark can write to will do and a code's bytes stand there as they are.

Ranges of ids are cut at quantiles; where one id takes up several of these, its rows are dealt to all of its ranges.

Cases: a null text is empty and has the end id alone; equal ids keep every row, in no set order; a null id sorts first;
an empty table gives an empty result; a document is never divided, however long; other columns are not looked at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, parts, two
from .tokens import WordEncoder

MAGIC = b"DAC2"
FILE_TOKENS = 1 << 20
RANGES = 4  # of ids, for each task
FILES = "bucket int, seq int, before long, n_tokens long, blob binary"


def write_codes(ids: np.ndarray, doc_ids: np.ndarray, ends: np.ndarray, nulls: int) -> bytes:
    levels, rest = [], ids.astype(np.uint32)
    while len(rest) or not levels:
        more = rest > 255
        words = (len(rest) + 63) // 64
        marks = np.zeros(words * 8, np.uint8)
        bits = np.packbits(more, bitorder="little")
        marks[: len(bits)] = bits
        marks = marks.view("<u8")
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)]).astype("<u4")
        levels.append(len(rest).to_bytes(8, "little") + (rest & 255).astype(np.uint8).tobytes() + marks.tobytes() + before.tobytes())
        rest = rest[more] >> 8
    return b"".join([MAGIC, len(doc_ids).to_bytes(4, "little"), len(levels).to_bytes(4, "little"), nulls.to_bytes(4, "little"), doc_ids.astype("<i8").tobytes(), ends.astype("<u8").tobytes(), *levels])


class CodeFile:
    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        docs, levels, self.nulls = np.frombuffer(blob, "<u4", 3, 4).tolist()
        at = 16

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            x = np.frombuffer(blob, kind, n, at)
            at += x.nbytes
            return x

        self.doc_ids, self.ends = take("<i8", docs), take("<u8", docs).astype(np.int64)
        self.levels = []
        for _ in range(levels):
            n = int(take("<u8", 1)[0])
            self.levels.append((take("u1", n), take("<u8", (n + 63) // 64), take("<u4", (n + 63) // 64 + 1)))

    def _rank(self, level: int, i: int) -> int:
        _, marks, before = self.levels[level]
        word, bit = i >> 6, i & 63
        return int(before[word]) + (int(marks[word]) & ((1 << bit) - 1)).bit_count() if bit else int(before[word])

    def get(self, i: int) -> int:
        """The id at a position."""
        value = 0
        for level, (chunks, marks, _) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * level)
            if not int(marks[i >> 6]) >> (i & 63) & 1:
                return value
            i = self._rank(level, i)
        raise ValueError("an id goes on after the last level")

    def read(self, start: int, stop: int) -> np.ndarray:
        """The ids of a range, from the bytes of that range on each level."""
        out = np.zeros(stop - start, np.uint32)
        at = np.arange(stop - start)
        for level, (chunks, marks, _) in enumerate(self.levels):
            if start >= stop:
                break
            out[at] |= chunks[start:stop].astype(np.uint32) << np.uint32(8 * level)
            first = start >> 6
            bits = np.unpackbits(marks[first : (stop + 63) >> 6].view(np.uint8), bitorder="little")
            at = at[bits[start - 64 * first : stop - 64 * first].astype(bool)]
            start, stop = self._rank(level, start), self._rank(level, stop)
        return out


def write_token_files(docs: DataFrame, path: str, end_id: int, out: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the table of files to the folder `out` and returns it: bucket (a range of document ids), seq (place in it),
    before (ids of the bucket's earlier files), n_tokens, blob."""
    spark = docs.sparkSession
    n = RANGES * parts(spark)
    rows = two(docs, id_col, text_col)
    cuts = rows.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)], max(10_000, 10 * n))).first()[0]
    cuts = np.array(cuts or [], np.int64)  # in order; an id that stands there more than once is a hot one

    def encode(batches):
        coder, end, turn = WordEncoder.of(path), end_id.to_bytes(2, "little"), 0
        for b in batches:
            none = b.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            ids = b.column("doc_id").fill_null(0).to_numpy()
            low, high = np.searchsorted(cuts, ids, "left"), np.searchsorted(cuts, ids, "right")
            at = turn + np.arange(len(ids))
            bucket = np.where(none, -1 - at % n, low + at % (high - low + 1)).astype(np.int32)  # null ids come first
            turn += len(ids)
            for i in range(0, len(ids), 512):
                packed = [coder.packed(x) + end for x in b.column("text").slice(i, 512).to_pylist()]
                part = slice(i, i + 512)
                yield pa.RecordBatch.from_arrays([pa.array(bucket[part]), b.column("doc_id").slice(i, 512), pa.array(packed, pa.binary())], names=["bucket", "doc_id", "ids"])

    def write(batches):
        held: list[tuple[int | None, bytes]] = []
        bucket, seq, size, before = None, 0, 0, 0

        def made():
            sizes = np.array([len(x) // 2 for _, x in held])
            nulls = sum(d is None for d, _ in held)
            blob = write_codes(np.frombuffer(b"".join(x for _, x in held), "<u2"), np.array([d or 0 for d, _ in held], np.int64), np.cumsum(sizes), nulls)
            return pa.RecordBatch.from_pylist([{"bucket": bucket, "seq": seq, "before": before, "n_tokens": int(sizes.sum()), "blob": blob}], schema=pa.schema([("bucket", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("blob", pa.binary())]))

        for b in batches:
            for k, d, x in zip(b.column("bucket").to_pylist(), b.column("doc_id").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if held and (k != bucket or size + len(x) // 2 > FILE_TOKENS):
                    yield made()
                    held, size, seq, before = [], 0, seq + 1, before + size
                if k != bucket:
                    bucket, seq, before = k, 0, 0
                held.append((d, x))
                size += len(x) // 2
        if held:
            yield made()

    coded = rows.mapInArrow(encode, "bucket int, doc_id long, ids binary").repartition(parts(spark), "bucket").sortWithinPartitions("bucket", "doc_id")
    coded.mapInArrow(write, FILES).write.option("compression", "none").parquet(out)
    return spark.read.schema(FILES).parquet(out)


def read_token_files(files: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per document, out of the files alone: doc_id, start, n_tokens, ids_crc32."""
    totals = files.groupBy("bucket").agg(F.sum("n_tokens").alias("n"))  # a row per range of ids
    offsets = totals.select("bucket", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("bucket_start"))
    placed = files.join(F.broadcast(scratch.table(offsets, "offsets")), "bucket").withColumn("start", F.col("bucket_start") + F.col("before"))

    def read(batches):
        for b in batches:
            for start, blob in zip(b.column("start").to_pylist(), b.column("blob"), strict=True):
                f = CodeFile(blob.as_py())
                begins = np.concatenate([[0], f.ends[:-1]]).astype(np.int64)
                crc = [zlib.crc32(f.read(s, e).astype("<u4").tobytes()) for s, e in zip(begins.tolist(), f.ends.tolist(), strict=True)]
                ids = pa.array(f.doc_ids, mask=np.arange(len(f.doc_ids)) < f.nulls)
                yield pa.RecordBatch.from_arrays([ids, pa.array(begins + start), pa.array(f.ends - begins), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.select("start", "blob").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The files written to scratch and read back."""
    scratch = Scratch(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, path, end_id, f"{scratch.path}/files", id_col, text_col), scratch)

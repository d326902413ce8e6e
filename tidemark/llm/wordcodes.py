"""Texts as numbers of words, with a table of distinct words for each chunk of documents.

One pass over the documents writes two kinds of rows to a scratch table: for each document the numbers of its words, in
order of place, and for each chunk (as many documents as share `words` distinct words or `tokens` words in all) its words
in order of number.
Only distinct words then take part in shuffles; what is found out about them comes back to the chunk by number.

A dictionary comes as rows of words with their counts, or, if owners are asked for, as one packed message to each owner (a
hash of the word) per chunk. The number of a word is then its place in the message times the owners, plus the owner.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

ROWS = "chunk long, doc_id long, flag boolean, n int, codes binary, first int, words array<binary>, times array<long>, blob binary"
SLICE = 20_000  # words of a dictionary in one row


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class _Owned(dict):
    """Numbers that tell the owner of a word."""

    def __init__(self, owners: int):
        super().__init__()
        self.by_owner: list[list] = [[] for _ in range(owners)]

    def __missing__(self, word):
        owner = zlib.crc32(word.encode()) % len(self.by_owner)
        own = self.by_owner[owner]
        self[word] = n = len(own) * len(self.by_owner) + owner
        own.append(word)
        return n


def pack_words(words: list[str]) -> bytes:
    """Words parted by a byte that UTF-8 does not have."""
    return zstandard.compress(b"\xff".join(w.encode() for w in words))


def unpack_words(blob: bytes) -> list[str]:
    return [w.decode() for w in zstandard.decompress(blob).split(b"\xff")]


def pack_codes(codes: np.ndarray) -> bytes:
    """Four byte planes, low bytes first: the high planes are nearly all zero and compress to nothing."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack_codes(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def code_words(docs: DataFrame, split: Callable, scratch: Scratch, words: int = 800_000, tokens: int = 8_000_000, owners: int = 0) -> tuple[DataFrame, DataFrame]:
    """docs(doc_id, raw binary, flag boolean). split: from bytes to a list of bytes, or with owners of texts. Returns the
    coded documents (chunk, doc_id, flag, n, codes) and the dictionaries: (chunk, at, word, times), where times counts the
    word in documents whose flag is true, or with owners (chunk, owner, blob)."""
    schema = pa.schema([("chunk", pa.int64()), ("doc_id", pa.int64()), ("flag", pa.bool_()), ("n", pa.int32()), ("codes", pa.binary()), ("first", pa.int32()), ("words", pa.list_(pa.binary())), ("times", pa.list_(pa.int64())), ("blob", pa.binary())])

    def run(batches):
        new = (lambda: _Owned(owners)) if owners else _Numbers
        chunk, numbers, times, size = TaskContext.get().partitionId() << 32, new(), np.zeros(1 << 16, np.int64), 0

        def table():
            if owners:
                for o, own in enumerate(numbers.by_owner):
                    if own:
                        yield pa.RecordBatch.from_pylist([{"chunk": chunk, "first": o, "blob": pack_words(own)}], schema=schema)
                return
            every = list(numbers)
            for i in range(0, len(every), SLICE):
                part = every[i : i + SLICE]
                yield pa.RecordBatch.from_pylist([{"chunk": chunk, "first": i, "words": part, "times": times[i : i + len(part)].tolist()}], schema=schema)

        for b in batches:
            for i in range(0, len(b), 256):
                part, ids, ns, codes, flags = b.slice(i, 256), [], [], [], []
                for doc_id, raw, flag in zip(part.column("doc_id").to_pylist(), part.column("raw"), part.column("flag").to_pylist(), strict=True):
                    own = split(raw.as_py())
                    c = np.fromiter(map(numbers.__getitem__, own), np.int64, len(own))
                    if flag and not owners:
                        if len(numbers) > len(times):
                            times = np.concatenate([times, np.zeros(len(numbers), np.int64)])
                        if len(c) * 8 > len(times):
                            times += np.bincount(c, minlength=len(times))
                        else:
                            np.add.at(times, c, 1)
                    ids.append(doc_id), ns.append(len(c)), codes.append(pack_codes(c)), flags.append(flag)
                k, size = len(ids), size + sum(ns)
                given = [pa.array([chunk] * k, pa.int64()), pa.array(ids, pa.int64()), pa.array(flags, pa.bool_()), pa.array(ns, pa.int32()), pa.array(codes, pa.binary())]
                yield pa.RecordBatch.from_arrays([*given, *(pa.nulls(k, f.type) for f in list(schema)[len(given) :])], schema=schema)
                if len(numbers) > words or size > tokens:
                    yield from table()
                    chunk, numbers, times, size = chunk + 1, new(), np.zeros(1 << 16, np.int64), 0
        if len(times) < len(numbers):
            times = np.concatenate([times, np.zeros(len(numbers), np.int64)])
        yield from table()

    # laid out by chunk: the coded texts are joined where they are, only words and what is known of them move
    both, again = scratch.bucketed(docs.select("doc_id", "raw", "flag").mapInArrow(run, ROWS), "coded", "chunk")
    coded = both.where("codes is not null").select("chunk", "doc_id", "flag", "n", "codes")
    if owners:
        return coded, again.where("blob is not null").select("chunk", F.col("first").alias("owner"), "blob")
    slices = again.where("words is not null").select("chunk", "first", F.posexplode(F.arrays_zip("words", "times")).alias("i", "w"))
    return coded, slices.select("chunk", (F.col("first") + F.col("i")).alias("at"), F.col("w.words").alias("word"), F.col("w.times").alias("times"))

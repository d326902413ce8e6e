"""Ranked lexical search (operator 12) over shards of documents.

A shard holds some thousands of whole documents: their terms in order, and for each term a run of postings (document in the
shard, integer impact) in CSR form. An impact is all of a term's score in a document that depends on the document,
(10^9 tf) div (1000 tf + 8 m), and needs only the number of documents and of terms, which a first pass over the texts
counts. The weight of a term depends on its document frequency, and is asked for the queries' terms alone: the shards send
the lengths of those runs. A query is then answered term at a time: weight times impact is added to a dense array over a
shard's documents; `argpartition` finds the k-th score, and of documents that tie with it the smallest ids are taken. A
task keeps the best k of all its shards, and Spark those of all tasks.

Queries are handled in blocks of bounded size, each block sent to all tasks in its turn; documents never move.

Cases: a null text or one without a term is in no count and is never found; an item without terms has no rows; rows of one
item id are one item with the terms of all; equal document ids are documents for themselves, which rank next to each other
where they tie; a null document id ranks after all others that tie; an item may have a null id; very long texts are cut
into terms part by part, with none left out; an empty table, of documents or of queries, gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, give_back, parts

#: A byte of a term as itself (A to Z lowered), any other as a space. All bytes of characters beyond ASCII are of terms.
TERM_BYTES = bytes(ord(chr(b).lower()) if chr(b).isalnum() and b < 128 else b if b >= 128 else 32 for b in range(256))
STEP = 1 << 20  # bytes of a text that are cut into terms at a time
SHARD_TERMS = 2_000_000  # a shard is closed by so many terms, repeats included, at the next end of a document
BLOCK_TERMS = 200_000  # a block of queries is closed by so many terms
INDEX = "n_docs int, doc_ids binary, nulls int, terms binary, starts binary, places binary, impacts binary"
FOUND = "item_id long, doc_id long, score long"


def terms_of(raw: bytes):
    """The terms of a text, in parts of bounded size."""
    if len(raw) <= STEP:
        yield raw.translate(TERM_BYTES).split()
        return
    held = b""
    for i in range(0, len(raw), STEP):
        part = held + raw[i : i + STEP].translate(TERM_BYTES)
        cut = part.rfind(b" ") + 1  # a term may go on in the next part
        yield part[:cut].split()
        held = part[cut:]
    yield held.split()


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("raw")).where("raw IS NOT NULL")


def corpus_size(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[int, int]:
    """The documents with a term, and all terms with repeats."""

    def run(batches):
        for b in batches:
            n = [sum(map(len, terms_of(x.as_py()))) for x in b.column("raw")]
            yield pa.RecordBatch.from_arrays([pa.array([sum(x > 0 for x in n)], pa.int64()), pa.array([sum(n)], pa.int64())], names=["docs", "terms"])

    total = _texts(docs, id_col, text_col).select("raw").mapInArrow(run, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return int(total[0] or 0), int(total[1] or 0)


class _Shard:
    """Documents that are gathered until there are enough for a row of the index."""

    def __init__(self, docs: int, terms: int):
        self.docs, self.terms = docs, terms
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.ids, self.codes, self.times, self.lengths, self.size = [], [], [], [], 0

    def add(self, doc_id: int | None, raw: bytes) -> None:
        numbers, n, seen, times = self.numbers, 0, [], []
        for some in terms_of(raw):
            if some:
                code = np.fromiter((numbers.setdefault(t, len(numbers)) for t in some), np.int64, len(some))
                code, count = np.unique(code, return_counts=True)
                seen.append(code), times.append(count)
                n += len(some)
        if not n:
            return
        code, count = seen[0], times[0]
        if len(seen) > 1:
            code, at = np.unique(np.concatenate(seen), return_inverse=True)
            count = np.bincount(at, np.concatenate(times)).astype(np.int64)
        m = 10 + 90 * n * self.docs // self.terms
        self.ids.append(doc_id), self.codes.append(code.astype(np.int32)), self.lengths.append(len(code))
        self.times.append((1_000_000_000 * count // (1000 * count + 8 * m)).astype(np.uint32))  # below 10^6
        self.size += n

    def row(self) -> pa.RecordBatch:
        none = np.array([x is None for x in self.ids])
        ids = np.array([x or 0 for x in self.ids], np.int64)
        order = np.lexsort((ids, none))  # places go by id, null ids last
        place = np.empty(len(ids), np.int32)
        place[order] = np.arange(len(ids), dtype=np.int32)
        terms = sorted(self.numbers)
        rank = np.empty(len(terms), np.int32)
        rank[np.fromiter((self.numbers[t] for t in terms), np.int64, len(terms))] = np.arange(len(terms), dtype=np.int32)
        code = rank[np.concatenate(self.codes)]
        where = np.repeat(place, self.lengths)
        by = np.lexsort((where, code))
        starts = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(terms)))]).astype(np.int64)
        made = [len(ids), ids[order].tobytes(), int(none.sum()), b" ".join(terms), starts.tobytes(), where[by].tobytes(), np.concatenate(self.times)[by].tobytes()]
        kinds = (pa.int32(), pa.binary(), pa.int32(), *[pa.binary()] * 4)
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(made, kinds, strict=True)], names=[x.split()[0] for x in INDEX.split(", ")])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_terms: int = SHARD_TERMS) -> tuple[DataFrame, int]:
    """The shards, as a lazy table of rows, and the number of documents with a term."""
    n_docs, n_terms = corpus_size(docs, id_col, text_col)

    def run(batches):
        shard = _Shard(n_docs, n_terms)
        for b in batches:
            for doc_id, raw in zip(b.column("doc_id").to_pylist(), b.column("raw"), strict=True):
                shard.add(doc_id, raw.as_py())
                if shard.size >= shard_terms:
                    yield shard.row()
                    shard.clear()
        if shard.size:
            yield shard.row()
        shard.clear()
        give_back()

    return _texts(docs, id_col, text_col).mapInArrow(run, INDEX), n_docs


def query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_id, terms: each item's distinct terms."""

    def run(batches):
        for b in batches:
            for item, raw in zip(b.column("doc_id").to_pylist(), b.column("raw"), strict=True):
                for some in terms_of(raw.as_py()):
                    own = list(set(some))
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(own), pa.int64()), pa.array(own, pa.binary())], names=["item_id", "term"])

    return _texts(items, id_col, text_col).mapInArrow(run, "item_id long, term binary").groupBy("item_id").agg(F.collect_set("term").alias("terms"))


def _blocks(items: DataFrame, most: int) -> DataFrame:
    """Items gathered to blocks of about so many terms, one row each: ids of items, and their terms."""

    def run(batches):
        ids, terms, size = [], [], 0

        def made():
            return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([terms], pa.list_(pa.list_(pa.binary())))], names=["items", "terms"])

        for b in batches:
            for item, own in zip(b.column("item_id").to_pylist(), b.column("terms"), strict=True):
                own = own.as_py()
                ids.append(item), terms.append(own)
                size += len(own)
                if size >= most:
                    yield made()
                    ids, terms, size = [], [], 0
        if ids:
            yield made()

    return items.coalesce(1 + parts(items.sparkSession) // 64).mapInArrow(run, "items array<long>, terms array<array<binary>>").withColumn("block", F.monotonically_increasing_id())


def _postings(row: dict) -> tuple[dict[bytes, int], np.ndarray]:
    return {t: i for i, t in enumerate(row["terms"].split(b" "))}, np.frombuffer(row["starts"], np.int64)


def _columns(batch: pa.RecordBatch):
    for i in range(len(batch)):
        yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def document_frequencies(index: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """Of the terms of a block of queries."""
    asked = index.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        total = np.zeros(len(asked.value), np.int64)
        for b in batches:
            for row in _columns(b):
                at, starts = _postings(row)
                own = np.fromiter((at.get(t, -1) for t in asked.value), np.int64, len(total))
                total += np.where(own < 0, 0, starts[own + 1] - starts[own])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    counted = index.select("terms", "starts").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    told = counted.toArrow()  # a row per term of the block at most
    return {terms[t]: n for t, n in zip(told.column("term").to_pylist(), told.column("df").to_pylist(), strict=True)}


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores above zero; of scores that tie at the end, the first places."""
    if len(scores) > k:
        least = scores[np.argpartition(scores, len(scores) - k)[len(scores) - k]]
        sure, tied = np.flatnonzero(scores > max(least, 0)), np.flatnonzero(scores == least) if least > 0 else np.empty(0, np.int64)
        own = np.concatenate([sure, tied[: k - len(sure)]])
    else:
        own = np.flatnonzero(scores > 0)
    return own[np.lexsort((own, -scores[own]))]


def _search(index: DataFrame, queries: list[tuple[int | None, list[tuple[bytes, int]]]], k: int) -> DataFrame:
    """queries: the items of a block, each with its terms and their weights. The best k of every task."""
    asked = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches):
        held = [[] for _ in asked.value]
        for b in batches:
            for row in _columns(b):
                at, starts = _postings(row)
                places, impacts = np.frombuffer(row["places"], np.int32), np.frombuffer(row["impacts"], np.uint32)
                ids, named = np.frombuffer(row["doc_ids"], np.int64), row["n_docs"] - row["nulls"]
                for item, (_, own) in enumerate(asked.value):
                    scores = np.zeros(row["n_docs"], np.int64)
                    for term, weight in own:
                        if (t := at.get(term)) is not None:
                            run_of = slice(starts[t], starts[t + 1])
                            scores[places[run_of]] += weight * impacts[run_of].astype(np.int64)  # a place is in a run once
                    if len(top := best(scores, k)):
                        found = [(-int(scores[p]), bool(p >= named), int(ids[p])) for p in top]
                        held[item] = sorted(held[item] + found)[:k]
        rows = [(i, None if none else d, -s) for (i, _), own in zip(asked.value, held, strict=True) for s, none, d in own]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [()] * 3, (pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["item_id", "doc_id", "score"])

    return index.mapInArrow(run, FOUND)


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", shard_terms: int = SHARD_TERMS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring documents of each item."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical")
    lazy, n_docs = build_index(docs, doc_id, doc_text, shard_terms)
    index = scratch.table(lazy, "index")
    blocks = scratch.table(_blocks(query_terms(items, item_id, item_text), block_terms), "blocks")
    found = spark.createDataFrame([], FOUND)
    for (block,) in blocks.select("block").collect():  # a number per block of BLOCK_TERMS terms
        ids, terms = blocks.where(F.col("block") == block).select("items", "terms").first()
        terms = [[bytes(t) for t in own] for own in terms]
        df = document_frequencies(index, sorted({t for own in terms for t in own}))
        weight = {t: int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * n + 1)))) for t, n in df.items()}
        top = _search(index, [(x, [(t, weight[t]) for t in own if t in weight]) for x, own in zip(ids, terms, strict=True)], k)
        found = found.unionByName(scratch.table(top, f"found-{block}"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")

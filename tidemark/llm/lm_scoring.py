"""LM scoring (operator 5): a gated recurrent language model over word counts of the whole training corpus.

All training documents are counted: every word's count, the number of tokens and of distinct ones. The model's units are
the most frequent words, one tail unit for each of 64 hashes of a word's first bytes, and the end. A word of the tail has
its unit's probability times its share, by count, of all that fall to that unit, with one count kept for unseen words.
The recurrent part is trained once on every training document, by the same rule at every size: the documents are dealt to
a few rounds; in each, replicas run over equal parts of its documents, each in one task, and their parameters are averaged
at its end. Words and counts meet by a join on distinct words of each chunk of documents; whole documents are scored in
one go, with the state carried from window to window.

Cases: a null text is empty and has the end alone; with no training document every count is zero and the base score of
any text is 0; a null id counts as empty text for the fold; repeated rows are counted and scored each; very long texts
are not cut; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fold, two
from .gru import Gru, fit, score
from .wordcodes import code_words, unpack_codes

CLASSES, IN_CLASS, TAILS = 32, 32, 64
END = 0
TOP = CLASSES * IN_CLASS - TAILS - 1  # the most frequent words; units 1..TOP
REPLICA_TOKENS = 1_000_000
GROUP_TOKENS = 2_000_000  # scored side by side


def _split(raw: bytes) -> list[bytes]:
    return raw.lower().split()  # bytes: only A-Z change, only ASCII white space divides


def _tail(word):
    return F.pmod(F.xxhash64(F.substring(word, 1, 3)), F.lit(TAILS)).cast("int")


def _join_counts(total: int, distinct: int, ends: int, tails: np.ndarray):
    """tails: for each tail unit, tokens and distinct words."""
    base = math.log10(max(1, total + distinct + 1))
    tail_base = np.log10(tails.sum(1) + 1.0)

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        at = known.column("at").to_numpy()
        count, unit = np.zeros(len(at), np.int64), np.zeros(len(at), np.uint16)
        count[at], unit[at] = known.column("c").to_numpy(), known.column("unit").to_numpy()
        lb = np.log10(count + 1.0)
        in_tail = unit > TOP
        tail = np.where(in_tail, lb - tail_base[np.where(in_tail, unit - TOP - 1, 0)], 0.0)
        end = math.log10(ends + 1) - base
        rows = []
        for turn, (doc_id, flag, codes) in enumerate(zip(docs.column("doc_id").to_pylist(), docs.column("flag").to_pylist(), docs.column("codes"), strict=True)):
            c = unpack_codes(codes.as_py())
            units = np.append(unit[c], np.uint16(END))
            rows.append((doc_id, flag, len(c) + 1, int((count[c] > 0).sum()) + (ends > 0), float(lb[c].sum() - base * len(c) + end), float(tail[c].sum()), units.astype("<u2").tobytes(), turn))
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int32())
        return pa.Table.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True) if rows else [()] * 8, kinds, strict=True)], names=["doc_id", "flag", "n_tokens", "n_known", "base_score", "tail", "units", "turn"])

    return run


def _units(blobs) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), "<u2").astype(np.int32) for x in blobs]


def _train(units: DataFrame, model: Gru, tokens: int, rounds: int) -> Gru:
    """One pass over all training documents in rounds of replicas, averaged by their tokens. A document's turn, its place in
    its chunk, decides the round: copies and rows that share an id are spread over all of them."""
    spark = units.sparkSession
    replicas = max(1, math.ceil(tokens / rounds / REPLICA_TOKENS))
    for i in range(rounds):
        own_turn = units.where(F.col("flag") & (F.col("turn") % rounds == i)).select("units").repartition(replicas)
        shared = spark.sparkContext.broadcast(model.flat())

        def run(batches, shared=shared):
            own = Gru(CLASSES, IN_CLASS, model.h).load(shared.value)
            weight = fit(own, [d for b in batches for d in _units(b.column("units"))], END)
            if weight:
                flat = own.flat().astype(np.float64)
                for i in range(0, len(flat), 1 << 16):
                    part = flat[i : i + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(i, i + len(part), dtype=np.int32)), pa.array(part * weight), pa.array(np.full(len(part), weight, np.int64))], names=["i", "v", "w"])

        mean = own_turn.mapInArrow(run, "i int, v double, w long").groupBy("i").agg((F.sum("v") / F.sum("w")).alias("v")).toArrow()  # a row per parameter
        if len(mean):
            flat = np.zeros(len(mean))
            flat[mean.column("i").to_numpy()] = mean.column("v").to_numpy()
            model = Gru(CLASSES, IN_CLASS, model.h).load(flat)
    return model


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2, hidden: int = 16, rounds: int = 4) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    rows = two(docs, id_col, text_col)
    rows = rows.select("doc_id", F.col("text").cast("binary").alias("raw"), (fold(F.col("doc_id"), folds) != held).alias("flag"))
    coded, words = code_words(rows, _split, scratch)
    counts = scratch.table(words.groupBy("word").agg(F.sum("times").alias("c")).where("c > 0"), "counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    ends = coded.where("flag").count()
    total, distinct = n + ends, v + (ends > 0)
    top = counts.orderBy(F.desc("c"), "word").limit(TOP).select("word", "c").collect()
    units = spark.createDataFrame([(bytes(x["word"]), i + 1) for i, x in enumerate(top)], "word binary, unit int")  # at most TOP rows
    rare = counts.join(F.broadcast(units), "word", "left_anti").groupBy(_tail("word").alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    tails = np.zeros((TAILS, 2), np.int64)
    for x in rare:
        tails[x["k"]] = x["c"], x["v"]
    named = words.select("chunk", "at", "word").join(scratch.shuffled(counts), "word", "left").join(F.broadcast(units), "word", "left")
    named = named.select("chunk", "at", F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("unit", _tail("word") + TOP + 1).alias("unit"))
    joined = coded.groupBy("chunk").cogroup(named.groupBy("chunk")).applyInArrow(_join_counts(total, distinct, ends, tails), "doc_id long, flag boolean, n_tokens long, n_known long, base_score double, tail double, units binary, turn int")
    joined = scratch.table(joined, "joined")
    model = Gru(CLASSES, IN_CLASS, hidden)
    model.set_frequencies(np.concatenate([[ends], [x["c"] for x in top], np.zeros(TOP - len(top)), tails[:, 0]]))
    model = _train(joined, model, total, rounds)
    shared = spark.sparkContext.broadcast(model.flat())

    def run(batches):
        own = Gru(CLASSES, IN_CLASS, hidden).load(shared.value)
        held_docs: list[np.ndarray] = []
        held_rows: list[tuple] = []

        def out():
            lp = score(own, held_docs, END) / math.log(10)
            cols = list(zip(*held_rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip([*cols[:5], lp + np.array(cols[5])], (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)], names=["doc_id", "flag", "n_tokens", "n_known", "base_score", "score"])

        size = 0
        for b in batches:
            columns = [b.column(c).to_pylist() for c in ("doc_id", "flag", "n_tokens", "n_known", "base_score", "tail")]
            for row, blob in zip(zip(*columns, strict=True), b.column("units"), strict=True):
                held_rows.append(row)
                held_docs += _units([blob])
                size += row[2]
                if size >= GROUP_TOKENS:
                    yield out()
                    held_docs, held_rows, size = [], [], 0
        if held_rows:
            yield out()

    scored = joined.mapInArrow(run, "doc_id long, flag boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", (~F.col("flag")).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")

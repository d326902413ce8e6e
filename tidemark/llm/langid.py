"""Language identification (operator 1): sparse multinomial logistic regression on TF-IDF of character n-grams, trained
by follow-the-regularised-leader with elastic-net penalties, then calibrated by temperature.

Texts are lower-cased; runs of anything but letters become one space; n-grams of one to three characters are hashed to
2^16 features. Document frequencies come from all training documents. The model is fitted on a bounded sample of them
(`sample_docs`, spread evenly over the languages, picked by a hash of id and text), one fifth of which sets the temperature.
A feature's value is its share of the text's n-grams, times its inverse document frequency, so a whole text of any
length is scored in one pass over its n-grams.

Cases: a null text, or one with no letter, is `und` with score 0; with no labelled training row everything is `und`; a
null id counts as empty text for the fold; repeated rows are scored each; an empty table gives an empty result; lang,
source and other columns are never looked at by a prediction.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, give_back

BITS = 16
SIZE = 1 << BITS
SCALE = np.float32(32.0)  # brings the shares to the order of one
#: Fixed odd multipliers of the hash, for the first, second and third character from the right.
MULT = np.array([2654435761, 2246822519, 3266489917], np.uint32)
SPREAD = np.array([668265263, 374761393, 2376512323], np.uint32)


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def ngrams(text: str) -> np.ndarray:
    """Hashed n-grams of a text, in any order; empty if it has no letter."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[cp]
    if not letter.any():
        return np.empty(0, np.uint16)
    cp = np.where(letter, cp, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    cp = np.concatenate([np.array([32], np.uint32), cp[keep], np.array([32], np.uint32)])
    shift = np.uint32(32 - BITS)
    h = cp * MULT[0]
    one = (h * SPREAD[0]) >> shift
    h = h[1:] ^ (cp[:-1] * MULT[1])
    two = (h * SPREAD[1]) >> shift
    h = h[1:] ^ (cp[:-2] * MULT[2])
    return np.concatenate([one, two, (h * SPREAD[2]) >> shift]).astype(np.uint16)


def _frequencies(batches):
    total, docs = np.zeros(SIZE, np.int64), 0
    for b in batches:
        for text in b.column("text"):
            seen = np.zeros(SIZE, bool)
            seen[ngrams(text.as_py())] = True
            total += seen
            docs += 1
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(total[at], docs))], names=["feature", "df"])


def _features(batches):
    for b in batches:
        idx, num = [], []
        for text in b.column("text"):
            i, n = np.unique(ngrams(text.as_py()), return_counts=True)
            idx.append(i.astype("<u2").tobytes()), num.append(n.astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("lang"), pa.array(idx, pa.binary()), pa.array(num, pa.binary())], names=["doc_id", "lang", "idx", "num"])


class FtrlSoftmax:
    """Multinomial logistic regression by FTRL-proximal with L1 and L2 penalties; weights are kept as z and n."""

    def __init__(self, features: int, classes: int, alpha: float = 0.5, beta: float = 0.1, l1: float = 0.02, l2: float = 0.02):
        self.z, self.n = np.zeros((features + 1, classes)), np.zeros((features + 1, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) > self.l1, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2), 0.0)

    def step(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[y] -= 1
        g = x[:, None] * p[None, :]
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits that makes held-back labels most likely, by golden-section search over its logarithm."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        s = logits / np.exp(t)
        return float(np.mean(np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - s[np.arange(len(y)), y]))

    a, b, r = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


class LanguageModel:
    def __init__(self, langs: list[str], weights: np.ndarray, bias: np.ndarray, heat: float):
        self.langs, self.weights, self.bias, self.heat = langs, weights.astype(np.float32), bias, heat

    def predict(self, text: str | None) -> tuple[str, float]:
        h = ngrams(text or "") if self.langs else ()
        if not len(h):
            return "und", 0.0
        if len(h) <= SIZE:
            total = self.weights[h].sum(0, dtype=np.float64)
        else:  # a very long text: by counts, so that no row of weights is taken for each of its n-grams
            total = np.bincount(h, minlength=SIZE) @ self.weights.astype(np.float64)
        s = total * (float(SCALE) / len(h)) + self.bias
        p = softmax(s / self.heat)
        k = int(p.argmax())
        return self.langs[k], float(min(1.0, p[k]))


def train(docs: DataFrame, sample_docs: int = 2_000, epochs: int = 3, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5) -> LanguageModel:
    """Learns from documents with a label whose fold is not 0."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    rows = rows.where((fold(F.col("doc_id"), folds) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {x["lang"]: x["count"] for x in rows.groupBy("lang").count().collect()}  # a row per language
    if not sizes:
        return LanguageModel([], np.zeros((SIZE, 0)), np.zeros(0), 1.0)
    langs, share = sorted(sizes), sample_docs / len(sizes)
    df = rows.select("text").mapInArrow(_frequencies, "feature int, df long").groupBy("feature").agg(F.sum("df").alias("df")).toArrow()  # a row per feature
    at, num = df.column("feature").to_numpy(), df.column("df").to_numpy()
    idf = np.full(SIZE, np.log(1.0 + num[at == -1][0]) + 1)
    idf[at[at >= 0]] = np.log((1.0 + num[at == -1][0]) / (1.0 + num[at >= 0])) + 1
    # by a hash of id and text, so that rows which share an id do not share their fate; twice the share of a language, of which
    # the first by that hash are kept: a bound that also holds where one row stands there very often
    limit = F.create_map(*[F.lit(v) for x in langs for v in (x, int(min(1.0, 2 * share / sizes[x]) * (1 << 30)))])
    turn = F.xxhash64("doc_id", "text", F.lit(17))
    picked = rows.withColumn("turn", turn).where(F.pmod("turn", F.lit(1 << 30)) < limit[F.col("lang")])
    first = F.row_number().over(Window.partitionBy("lang").orderBy("turn", "doc_id"))
    picked = picked.withColumn("nth", first).where(F.col("nth") <= math.ceil(share))
    sample = picked.select("doc_id", "lang", "text").mapInArrow(_features, "doc_id long, lang string, idx binary, num binary").toArrow()
    data = []
    for d, lang, i, n in sorted(zip(*(sample.column(c).to_pylist() for c in ("doc_id", "lang", "idx", "num")), strict=True), key=lambda x: (x[0] is None, x[0], x[1])):
        if i:
            i, n = np.frombuffer(i, "<u2").astype(np.int64), np.frombuffer(n, "<u4")
            data.append((np.append(i, SIZE), np.append(n / n.sum() * idf[i] * float(SCALE), 1.0), langs.index(lang)))
    order = np.random.default_rng(3).permutation(len(data))
    held = order[: len(order) // 5] if len(order) >= 50 else order[:0]
    model = FtrlSoftmax(SIZE, len(langs))
    for _ in range(epochs):
        for k in order[len(held) :]:
            model.step(*data[k])
    w = model.weights()
    logits = np.array([data[k][1] @ w[data[k][0]] for k in held]).reshape(len(held), len(langs))
    return LanguageModel(langs, w[:SIZE] * idf[:, None], w[SIZE], temperature(logits, np.array([data[k][2] for k in held], int)))


def accept(docs: DataFrame, model: LanguageModel, least: float, text_col: str = "text") -> DataFrame:
    """The rows of docs, as they are, whose text has a language with a score of `least` or more."""
    at, shared = docs.columns.index(text_col), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for whole in batches:
            for i in range(0, len(whole), 512):
                b = whole.slice(i, 512)
                told = [shared.value.predict(x.as_py()) for x in b.column(at)]
                yield b.filter(pa.array([lang != "und" and score >= least for lang, score in told], pa.bool_()))
        give_back()

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_as: str = "lang_pred", score_as: str = "score") -> DataFrame:
    """All columns of docs, then the language and the score under names that docs must not have."""
    names = docs.columns
    if {lang_as, score_as} & set(names):
        raise ValueError(f"docs has a column {lang_as} or {score_as}")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^16 weights for each language

    def run(batches):
        for b in batches:
            out = [shared.value.predict(x.as_py()) for x in b.column(names.index(text_col))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())], names=[*names, lang_as, score_as])

    schema = T.StructType([*docs.schema.fields, T.StructField(lang_as, T.StringType()), T.StructField(score_as, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def language_id(docs: DataFrame, sample_docs: int = 2_000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    model = train(docs, sample_docs, 3, id_col, text_col, lang_col, folds)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return identify(rows, model).select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "lang_pred", "score")

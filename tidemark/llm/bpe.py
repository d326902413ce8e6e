"""BPE encoding and decoding (operator 10) through a table of distinct words.

Texts are split in Spark into the words of the tokenizer's pattern, which no token crosses; where a text has characters
whose classes depend on the version of Unicode, into runs of white space with what follows up to the next.
Every chunk of documents sends its distinct words to their owners, which encode each distinct word of the corpus once, by
the tokenizers library, and answer with ids; in the chunk these go to every place by the word's number. Decoding joins
ids to the table of pieces, whose size is that of the vocabulary, and reads the joined bytes as UTF-8.

Cases: a null or empty text has no ids and decodes to the empty text; the special token's string in a text is that token,
as in the library; repeated rows and ids are kept; very long texts are not cut; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import Scratch, owners_of, two
from .tokens import BYTE_PATTERN, SETTLED, SPACES, byte_names
from .wordcodes import code_words, unpack_codes, unpack_words

PATTERN = regex.compile(BYTE_PATTERN)
CHUNK = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
ODD = re.compile("[" + "".join(c for c in SPACES if c not in " \t\n\x0b\x0c\r") + "]")


def words_of(raw: bytes) -> list[str]:
    """Words that no token crosses; joined they are the text."""
    text = raw.decode()
    if "<|" not in text and (text.isascii() or SETTLED.fullmatch(text)):
        return PATTERN.findall(text)
    return mixed_words(text) if ODD.search(text) else CHUNK.findall(text)


def mixed_words(text: str) -> list[str]:
    """White space is what the library's pattern takes for it: all of Unicode's, without the four separators 1c-1f."""
    space = "".join(c for c in SPACES if c not in "\x1c\x1d\x1e\x1f")
    return re.findall(f"[{space}]*[^{space}]+|[{space}]+", text)


class Ragged:
    """Items of several values each, as one flat array with starts and lengths; items are taken by number."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray):
        self.flat, self.lengths = flat, lengths.astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def take(self, at: np.ndarray) -> np.ndarray:
        n = self.lengths[at]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[at] - (ends - n), n) + np.arange(total)]


@functools.cache
def library_of(path: str) -> Tokenizer:
    """One for each file and Python worker; a file loaded anew for every group leaves the worker's memory in pieces."""
    return Tokenizer.from_file(path)


@functools.cache
def pieces(path: str) -> Ragged:
    """The bytes of every id, from the vocabulary of the file."""
    library = library_of(path)
    letters = {c: b for b, c in byte_names().items()}
    special = {i: t.content for i, t in library.get_added_tokens_decoder().items()}
    out = [b""] * library.get_vocab_size()
    for token, i in library.get_vocab().items():
        out[i] = special[i].encode() if i in special else bytes(letters[c] for c in token)
    return Ragged(np.frombuffer(b"".join(out), np.uint8), np.array([len(x) for x in out]))


def pack_ids(ids: list[bytes]) -> bytes:
    """Ids of words, each as 16-bit integers: how many words, how many ids each has, the ids."""
    return zstandard.compress(len(ids).to_bytes(4, "little") + np.array([len(x) // 2 for x in ids], "<u4").tobytes() + b"".join(ids))


def unpack_ids(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(blob)
    n = int.from_bytes(raw[:4], "little")
    return np.frombuffer(raw, "<u4", n, 4), np.frombuffer(raw, "<u2", offset=4 + 4 * n)


def _encode(path: str):
    def run(messages: pa.Table) -> pa.Table:
        """An owner: every distinct word that is sent to it is encoded once, and every message is answered."""
        library, known, out = library_of(path), {}, []
        if library.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit in 16 bits")
        for blob in messages.column("blob"):
            words = unpack_words(blob.as_py())
            for w in words:  # one at a time: a batch holds much more for each word than its ids, on threads of its own
                if w not in known:
                    known[w] = array("H", library.encode(w, add_special_tokens=False).ids).tobytes()
            out.append(pack_ids([known[w] for w in words]))
        return pa.table({"chunk": messages.column("chunk"), "owner": messages.column("owner"), "blob": pa.array(out, pa.binary())})

    return run


def _restore(path: str, owners: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        """A chunk: the ids of its words back in every place."""
        own = [(o, *unpack_ids(b.as_py())) for o, b in zip(answers.column("owner").to_pylist(), answers.column("blob"), strict=True)]
        size = max(((len(n) - 1) * owners + o + 1 for o, n, _ in own), default=0)
        words = Ragged(np.concatenate([np.empty(0, "<u2"), *(i for _, _, i in own)]), np.zeros(size))
        at = 0
        for o, n, ids in own:
            numbers = np.arange(len(n)) * owners + o
            words.lengths[numbers], words.starts[numbers] = n, at + np.cumsum(n, dtype=np.int64) - n
            at += len(ids)
        text, rows = pieces(path), []
        for doc_id, codes in zip(docs.column("doc_id").to_pylist(), docs.column("codes"), strict=True):
            ids = words.take(unpack_codes(codes.as_py()))
            decoded = text.take(ids).tobytes().decode("utf-8", "replace")
            rows.append((doc_id, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.Table.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True) if rows else [()] * 4, kinds, strict=True)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    scratch = Scratch(docs.sparkSession, "bpe")
    raw = two(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("raw"), F.lit(False).alias("flag"))
    owners = owners_of(docs)
    coded, messages = code_words(raw, words_of, scratch, owners=owners)
    answers = messages.groupBy("owner").applyInArrow(_encode(path), "chunk long, owner int, blob binary")
    found = coded.select("chunk", "doc_id", "codes").groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return found.applyInArrow(_restore(path, owners), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

"""Token counts (operator 13) by merging with a heap and a linked list.

A word begins as one symbol a byte. The adjacent pairs that have a rank stand in a heap, by rank and then place; the lowest
is popped, its right symbol unlinked, and the pairs with the new symbol are pushed. A word's count is its first symbols less
its merges: no id is ever made. Words come from the file's own rules (special tokens out of the raw text, normal form, lower
case, the word pattern), and each worker keeps the counts of words it has met in caches of bounded size. No row moves.

Cases: a null or empty text, and one of white space alone, has no tokens; a special token's string in a text is one token;
very long texts are not cut, and a word of any length takes time in proportion to n log n; repeated rows and ids are kept;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import give_back, two
from .tokens import SETTLED, WORD_PATTERN, byte_names

WORD_END = "</w>"
HELD = 300_000  # entries in each of a worker's two caches
LONG = 64  # characters; longer words are not held


class MergeCounter:
    """Counts the tokens of texts under a file of byte pairs with word ends."""

    def __init__(self, path: str):
        library = Tokenizer.from_file(path)
        about = json.loads(library.to_str())
        model, cut = about["model"], about["pre_tokenizer"]
        normal = [x["type"] for x in (about["normalizer"] or {}).get("normalizers", [])]
        plain = not (model.get("dropout") or model.get("unk_token") or model.get("ignore_merges") or model.get("byte_fallback") or model.get("continuing_subword_prefix"))
        if not plain or model.get("end_of_word_suffix") != WORD_END or cut["type"] != "Sequence" or cut["pretokenizers"][0]["pattern"] != {"Regex": WORD_PATTERN} or normal != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path} is of a kind that is not supported")
        self.normal, self.cut = library.normalizer, library.pre_tokenizer
        self.pattern = regex.compile(WORD_PATTERN)
        self.special = [x["content"] for x in about["added_tokens"]]
        self.specials = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        letters = byte_names()
        if any(c + e not in model["vocab"] for c in letters.values() for e in ("", WORD_END)):
            raise ValueError("every byte must be a symbol, also at the end of a word")
        number = {c + e: 2 * b + bool(e) for b, c in letters.items() for e in ("", WORD_END)}
        self.byte = {c: b for b, c in letters.items()}
        self.rank: dict[int, int] = {}  # of a pair of symbols
        self.made: list[int] = []  # the symbol that the merge of this rank makes
        for left, right in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.rank.setdefault(number[left] << 32 | number[right], len(self.made))
            self.made.append(number.setdefault(left + right, len(number)))
        self.words: dict[str, int] = {}
        self.chunks: dict[str, int] = {}

    def merged(self, raw: bytes) -> int:
        """The count of one word's bytes."""
        if len(raw) < 2:
            return len(raw)
        rank, made, end = self.rank, self.made, len(raw)
        symbol = [2 * b for b in raw]
        symbol[-1] += 1
        after, before, count = list(range(1, end + 1)), list(range(-1, end - 1)), end
        heap = [r << 32 | i for i in range(end - 1) if (r := rank.get(symbol[i] << 32 | symbol[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            top = heapq.heappop(heap)
            r, i = top >> 32, top & 0xFFFFFFFF
            j = after[i]
            if symbol[i] < 0 or j == end or rank.get(symbol[i] << 32 | symbol[j]) != r:
                continue  # one of the two was merged meanwhile
            symbol[i], symbol[j] = made[r], -1
            k = after[i] = after[j]
            count -= 1
            if k != end:
                before[k] = i
                if (x := rank.get(symbol[i] << 32 | symbol[k])) is not None:
                    heapq.heappush(heap, x << 32 | i)
            if (h := before[i]) >= 0 and (x := rank.get(symbol[h] << 32 | symbol[i])) is not None:
                heapq.heappush(heap, x << 32 | h)
        return count

    def _word(self, word: str) -> int:
        if (n := self.words.get(word)) is None:
            n = self.merged(word.encode())
            if len(word) <= LONG:
                self.words[word] = n
        return n

    def _chunk(self, chunk: str) -> int:
        """What stands between white space: no token and no normal form crosses that."""
        if SETTLED.fullmatch(chunk):
            n = sum(map(self._word, self.pattern.findall(unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower())))
        else:  # characters whose classes depend on the version of Unicode are cut by the library
            n = sum(self.merged(bytes(map(self.byte.__getitem__, w))) for w, _ in self.cut.pre_tokenize_str(self.normal.normalize_str(chunk)))
        if len(chunk) <= LONG:
            self.chunks[chunk] = n
        return n

    def count(self, text: str) -> int:
        for held in (self.words, self.chunks):
            if len(held) > HELD:
                held.clear()
        total, known, parts = 0, self.chunks, [text]
        if self.specials and any(s in text for s in self.special):
            parts = self.specials.split(text)
            total = len(parts) - 1
        for part in parts:
            for chunk in part.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "):
                n = known.get(chunk)
                total += self._chunk(chunk) if n is None else n
        return total


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more tokens than the limit)."""

    def run(batches):
        counter = MergeCounter(path)
        for b in batches:
            for i in range(0, len(b), 512):
                part = b.slice(i, 512)
                text = part.column("text")
                n = [counter.count(x.as_py()) for x in text]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pc.binary_length(text).cast(pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
        give_back()

    return two(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

"""Fast exact encoding with the tokenizers library: words are cut where its tokens can never cross, and encoded once.

Two kinds of tokenizer file are understood: byte-level BPE with the usual word pattern (`byte`), and BPE with word ends,
which lower-cases and drops white space (`word`). Any other file is refused. The library's BPE model encodes every
distinct word; the rest is cutting at its own boundaries and caches of bounded size, held by the Python worker.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from array import array

import numpy as np
import regex
from tokenizers import Tokenizer

# The word patterns of the two kinds of file.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

assert sys.byteorder == "little"
#: All that counts as white space in Python; a text where one stands before a space takes the slower way.
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
#: Characters whose classes are the same in all versions of Unicode in use; a word with any other is left to the library.
SETTLED = regex.compile(r"[\x00-\u024f\u0391-\u03a1\u03a3-\u03a9\u03b1-\u03c9\u0410-\u044f\u2010-\u2027\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]*")
CHUNKS, PIECES = 400_000, 250_000  # entries in a worker's caches, about 180 MB when full
ENDS = frozenset(".,;:!?")


def byte_names() -> dict[int, str]:
    """Byte-level BPE's letter for each byte: itself if it prints, else the next free code point from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(prints)]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Cache(dict):
    """Ids of words: filled by a function when a word is first asked for."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        found = self[word] = self.make(word)
        return found


class WordEncoder:
    _held: dict[str, WordEncoder] = {}

    @classmethod
    def of(cls, path: str, most: int = CHUNKS) -> WordEncoder:
        """One for each file and Python worker. most: entries in the largest of its caches."""
        if path not in cls._held:
            cls._held[path] = cls(path)
        cls._held[path].most = most
        return cls._held[path]

    def __init__(self, path: str):
        self.library, self.most = Tokenizer.from_file(path), CHUNKS
        about = json.loads(self.library.to_str())
        cut = about["pre_tokenizer"]
        if cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"] and about["normalizer"] is None:
            self.kind, self.pattern = "byte", regex.compile(BYTE_PATTERN)
        elif cut["type"] == "Sequence" and cut["pretokenizers"][0]["pattern"] == {"Regex": WORD_PATTERN} and [x["type"] for x in about["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]:
            self.kind, self.pattern = "word", regex.compile(WORD_PATTERN)
        else:
            raise ValueError(f"{path} is of a kind that is not supported")
        if self.library.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit in 16 bits")
        self.special = {x["content"]: x["id"].to_bytes(2, "little") for x in about["added_tokens"]}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.model, self.names = self.library.model, byte_names()
        self.chunks, self.plain_chunks, self.pieces = _Cache(self._latin), _Cache(self._spaced), _Cache(self._piece)
        self.before = " " if self.kind == "byte" else ""

    def _piece(self, piece: str) -> bytes:
        """Ids of what the pattern finds, by the library's model."""
        spelt = piece.replace(" ", self.names[32]) if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.names)
        return array("H", [t.id for t in self.model.tokenize(spelt)]).tobytes()  # little-endian, as asserted above

    def _spaced(self, word: str) -> bytes:
        return self._plain(self.before + word)

    def _latin(self, word: str) -> bytes:
        """A word of Latin-1: letters alone, or with one mark behind them, are what the pattern finds."""
        if word.isalpha():
            return self.pieces[self.before + word]
        if word[-1:] in ENDS and word[:-1].isalpha():
            return self.pieces[self.before + word[:-1]] + self.pieces[word[-1]]
        return self._plain(self.before + word)

    def _plain(self, text: str) -> bytes:
        """Ids of a text of any form: special tokens, then words by the pattern."""
        if not SETTLED.fullmatch(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
        out = []
        for i, part in enumerate(self.specials.split(text) if self.specials else [text]):
            if i % 2:
                out.append(self.special[part])
                continue
            if self.kind == "word":
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            out += map(self.pieces.__getitem__, self.pattern.findall(part))
        return b"".join(out)

    def packed(self, text: str) -> bytes:
        """Ids of a text as little-endian 16-bit integers."""
        for cache, most in ((self.chunks, self.most), (self.plain_chunks, self.most // 4), (self.pieces, self.most * PIECES // CHUNKS)):
            if len(cache) > most:
                cache.clear()
        if self.kind == "word" and self.specials and self.specials.search(text):
            return self._plain(text)  # special tokens are found before letters are lowered
        latin = _is_latin(text)
        chunks = self.chunks if latin else self.plain_chunks
        if self.kind == "word":
            if latin:
                text = text.lower()  # of these characters none is changed by NFC, and each is lowered for itself
            return b"".join(map(chunks.__getitem__, text.replace("\n", " ").split(" ")))
        spaces = SPACES[:10] if text.isascii() else SPACES
        if any(c + " " in text for c in spaces):
            return self._plain(text)
        first, *words = text.split(" ")
        return self._plain(first) + b"".join(map(chunks.__getitem__, words))

    def forget(self) -> None:
        """Empties the caches, at the end of a task."""
        for cache in (self.chunks, self.plain_chunks, self.pieces):
            cache.clear()

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.packed(text), "<u2")

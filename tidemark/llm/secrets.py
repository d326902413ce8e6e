"""Secret scans (operator 2): assignment-aware lexing.

Three fixed patterns give the base spans. The method reads source and configuration syntax around every assignment sign
into name-literal pairs (quoted strings, bare words, sums of these, names of earlier constants, `${NAME}` in strings),
propagates constants, and scores each literal by how sensitive the name is that it ends up under. Literals that score
0.5 or more become spans of kind `literal`; base spans stay as they are.

Work is in proportion to the text: a value is kept as its literals, links to the values it is made of, and a summary of
bounded size, so that sums of sums are never written out. A bare word is a literal however long it is, and so are its ends
after signs inside it; those of over 512 characters are summed up by counts that move along with the word.

Cases: a null text is empty; empty texts have no spans and the digest of the empty text; positions are code points, ends
exclusive; a text is scanned whole, however long; repeated rows are scanned each; an empty table gives an empty result;
other columns are not looked at, and `redact` keeps them.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, two

# The base patterns and the least length of each.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so shorter ones need not be found and dropped
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "literal")

# Words of a name that make its value sensitive, alone or in pairs, with their weight.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "auth": 0.6, "authorization": 0.8, "bearer": 0.8, "signature": 0.6, "pin": 0.5}
SENSITIVE_PAIRS = {("api", "key"): 1.0, ("access", "key"): 1.0, ("private", "key"): 1.0, ("secret", "key"): 1.0, ("encryption", "key"): 0.9, ("signing", "key"): 0.9, ("session", "key"): 0.8, ("account", "key"): 0.8, ("client", "secret"): 1.0, ("connection", "string"): 0.7}
PHRASES = frozenset({"password", "passwd", "passphrase", "pwd"})  # their quoted values may have spaces
PLACEHOLDERS = re.compile(r"(?i)(changeme|change_me|example|placeholder|password|secret|token|none|null|true|false|todo|test|dummy|sample|(your|my)([-_ ]?(api|access|secret|private))?[-_ ]?(password|passwd|secret|token|key)?([-_ ]?(goes)?[-_ ]?here)?|x+|\*+|\.+|<[^<>]*>|\$?\{[^{}]*\}|%s|%\(\w*\)s)")

SIGN = re.compile(r":=|=>|[=:]")
GAP = re.compile(r"[ \t]*")
QUOTED = re.compile(r'''"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)\'|`([^`\n]*)`''')
BARE = re.compile(r"""[^\s,;(){}\[\]"'`<>|&]+""")
NAME = re.compile(r"[A-Za-z_$][\w.$-]*", re.A)
PLUS = re.compile(r"[ \t]*(?:\+|\.\.|\.(?=[ \t]*[\"'])|&)[ \t]*")
INSIDE = re.compile(r"\$\{([A-Za-z_]\w*)\}|\$([A-Za-z_]\w*)|#\{([A-Za-z_]\w*)\}", re.A)
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
LONGEST, STEP = 512, 1_024  # characters of a bare word that is summed up by itself; between counts that are kept of a longer one
NAME_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_.$-")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


@lru_cache(1 << 12)
def name_weight(name: str) -> float:
    words = [w.lower() for w in WORDS.findall(name)]
    return max([0.0, *(SENSITIVE.get(w, 0.0) for w in words), *(SENSITIVE_PAIRS.get(p, 0.0) for p in zip(words, words[1:], strict=False))])


class Value:
    """What is assigned: its own literals as spans, the earlier values it is made of, and a summary of all of it: length,
    share of each character (by code point modulo 256), classes of characters, whether there is a space, and the value
    itself if it is short."""

    __slots__ = ("spans", "parts", "told", "raw", "length", "share", "classes", "space", "short")

    def __init__(self, pieces: list):
        """pieces: (start, end, string, or the long word that it ends) of literals, or earlier values."""
        self.spans = [x[:2] for x in pieces if type(x) is tuple]
        self.parts = [x for x in pieces if type(x) is not tuple]
        self.told, self.raw, self.length, self.share, self.classes, self.space, self.short = False, None, 0, {}, 0, False, ""
        if len(pieces) == 1 and not self.parts:
            self.raw = pieces[0]  # most values are a literal under a plain name, and nobody asks for their summary
            return
        for x in pieces:
            self._add(*(_piece_summary(x) if type(x) is tuple else x.summary()))

    def summary(self) -> tuple[int, dict, int, bool, str | None]:
        if self.raw is not None:
            (self.length, self.share, self.classes, self.space, self.short), self.raw = _piece_summary(self.raw), None
        return self.length, self.share, self.classes, self.space, self.short

    def _add(self, length: int, share: dict, classes: int, space: bool, short: str | None) -> None:
        total = self.length + length
        if length and self.length:
            a, b = self.length / total, length / total
            self.share = {c: a * self.share.get(c, 0.0) + b * share.get(c, 0.0) for c in self.share.keys() | share.keys()}
        elif length:
            self.share = share
        self.classes, self.space = self.classes | classes, self.space or space
        self.short = None if self.short is None or short is None or total > 64 else self.short + short
        self.length = min(total, 1 << 40)

    def weight(self, spaces: bool) -> float:
        """How much it looks made by a machine or chosen as a password: length, spread of characters, mixed classes."""
        if self.raw is not None and type(self.raw[2]) is Word:
            return _looks(self.raw[1] - self.raw[0], self.raw[2].bits(self.raw[0]), self.raw[2].classes(self.raw[0]))
        self.summary()
        if self.length < 6 or (self.space and not spaces) or (self.short is not None and PLACEHOLDERS.fullmatch(self.short)):
            return 0.0
        bits = -sum(p * math.log2(p) for p in self.share.values() if p)
        return _looks(self.length, bits, self.classes)

    def tell(self) -> list[tuple[int, int]]:
        """Spans of all literals in it, without those that were told before."""
        out, todo = [], [self]
        while todo:
            v = todo.pop()
            if not v.told:
                v.told = True
                out += v.spans
                todo += v.parts
        return out


def _looks(length: int, bits: float, classes: int) -> float:
    return min(1.0, 0.25 * min(length, 20) / 20 + 0.35 * min(bits, 3.5) / 3.5 + 0.2 * min(classes.bit_count(), 3))


class Word:
    """A bare word of over LONGEST characters, text[start:end], of which every end after a sign inside it may be a literal.
    What `weight` asks of an end is had from counts that move along, as signs come in order; the shares of an end, from
    counts that are kept every STEP characters."""

    __slots__ = ("start", "end", "codes", "at", "count", "sum", "last", "kept")

    def __init__(self, text: str, start: int, end: int):
        code = np.frombuffer(text[start:end].encode("utf-32-le", "surrogatepass"), "<u4")
        self.start, self.end, self.at, self.kept = start, end, start, None
        self.codes = code.astype(np.uint8)  # modulo 256
        self.count = np.bincount(self.codes, minlength=256).tolist()
        self.sum = sum(c * math.log2(c) for c in self.count if c)
        low, high, digit = ((code >= ord(a)) & (code <= ord(z)) for a, z in ("az", "AZ", "09"))
        self.last = [start + int(x[-1]) if len(x := np.nonzero(own)[0]) else -1 for own in (low, high, digit, ~(low | high | digit))]

    def bits(self, at: int) -> float:
        """The spread of the characters from `at` on, which is no less than in the call before."""
        count, log = self.count, math.log2
        for c in self.codes[self.at - self.start : at - self.start].tolist():
            n = count[c]
            count[c] = n - 1
            self.sum += ((n - 1) * log(n - 1) if n > 1 else 0.0) - n * log(n)
        self.at = at
        return math.log2(self.end - at) - self.sum / (self.end - at)

    def classes(self, at: int) -> int:
        a, b, c, d = self.last
        return (a >= at) | (b >= at) << 1 | (c >= at) << 2 | (d >= at) << 3

    def summary(self, at: int) -> tuple[int, dict, int, bool, str | None]:
        if self.kept is None:  # how often each character stands from every so many on
            n = len(self.codes) // STEP + 1
            own = np.array([np.bincount(self.codes[i * STEP : (i + 1) * STEP], minlength=256) for i in range(n)] + [np.zeros(256, np.int64)])
            self.kept = own[::-1].cumsum(0)[::-1].astype(np.uint32)
        i = at - self.start
        j = i // STEP + 1
        count = self.kept[j] + np.bincount(self.codes[i : j * STEP], minlength=256)
        found = np.nonzero(count)[0]
        length = self.end - at
        return length, dict(zip(found.tolist(), (count[found] / length).tolist(), strict=True)), self.classes(at), False, None


def _piece_summary(piece: tuple) -> tuple[int, dict, int, bool, str | None]:
    return piece[2].summary(piece[0]) if type(piece[2]) is Word else _summary(piece[2])


def _summary(body: str) -> tuple[int, dict, int, bool, str | None]:
    count = Counter(body)
    share: dict[int, float] = {}
    classes, space = 0, False
    for c, n in count.items():
        share[ord(c) & 255] = share.get(ord(c) & 255, 0.0) + n / len(body)
        classes |= 1 if "a" <= c <= "z" else 2 if "A" <= c <= "Z" else 4 if "0" <= c <= "9" else 8
        space = space or c.isspace()
    return len(body), share, classes, space, body if len(body) <= 64 else None


def literals(text: str) -> list[tuple[int, int]]:
    """Spans of the literals that end up under a sensitive name."""
    known: dict[str, Value] = {}
    found: list[tuple[int, int]] = []
    upto = run = 0  # signs before the first are inside a quoted value; the bare word that was met last ends at the second
    word: Word | None = None  # that word, if it is a long one
    for sign in SIGN.finditer(text):
        p = sign.start()
        if p < upto:
            continue
        j = p
        while j and text[j - 1] in " \t":
            j -= 1
        while j and text[j - 1] in "\"']":
            j -= 1
        k = j
        while k and text[k - 1] in NAME_CHARS:
            k -= 1
        name = text[k:j].lstrip("0123456789.-$")
        if not name or text.startswith("//", sign.end()) or text[p : p + 2] == "==" or (p and text[p - 1] in "=!<>"):
            continue
        at, pieces, first, bare = GAP.match(text, sign.end()).end(), [], True, False
        while True:
            if m := QUOTED.match(text, at):
                start, end, last = m.start() + 1, m.end() - 1, m.start() + 1
                for n in INSIDE.finditer(text, start, end):
                    if (v := known.get(n[1] or n[2] or n[3])) is not None:
                        pieces += [(last, n.start(), text[last : n.start()])] * (n.start() > last) + [v]
                        last = n.end()
                if last == start:
                    pieces.append((start, end, text[start:end]))
                elif end > last:
                    pieces.append((last, end, text[last:end]))
                at = upto = m.end()
            elif (m := NAME.match(text, at)) and m[0] in known and (m.end() == len(text) or text[m.end()] not in NAME_CHARS):
                pieces.append(known[m[0]])
                at = m.end()
            elif first and (at < run or BARE.match(text, at)):
                if at >= run:
                    run, word = BARE.match(text, at).end(), None
                    if run - at > LONGEST:
                        word = Word(text, at, at + len(text[at:run].rstrip(".:!?")))
                end = at + len(text[at:run].rstrip(".:!?")) if word is None or run - at <= LONGEST else max(at, word.end)
                pieces.append((at, end, text[at:end] if end - at <= LONGEST else word))
                at, bare = run, True
            else:
                break
            first = False
            if not (more := PLUS.match(text, at)):
                break
            at = more.end()
        if pieces:
            weight = name_weight(name)
            value = known[name] = pieces[0] if len(pieces) == 1 and type(pieces[0]) is Value else Value(pieces)
            if weight and weight * value.weight(not bare and not PHRASES.isdisjoint(w.lower() for w in WORDS.findall(name))) >= 0.5:
                found += value.tell()
    return found


def scan(text: str) -> list[tuple[str, int, int]]:
    """All spans, by start, then kind as listed."""
    found = base_spans(text)
    if ":" in text or "=" in text:
        found += [("literal", *s) for s in set(literals(text)) if s[1] > s[0]]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""

    def run(batches):
        for b in batches:
            every = [scan(x.as_py()) for x in b.column("text")]
            base = [[s for s in own if s[0] != "literal"] for own in every]
            count = [Counter(s[0] for s in own) for own in base]
            sha = [hashlib.sha256(joined(own).encode()).hexdigest() for own in base]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array([c[k] for c in count], pa.int64()) for k in KINDS[:3]), pa.array(sha), pa.array([joined(own) for own in every])], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return two(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def mask(text: str) -> str:
    """The text with every span replaced by its kind; spans that touch or overlap become one."""
    out, at = [], 0
    merged: list[list] = []
    for k, a, b in scan(text):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(b, merged[-1][2])
        else:
            merged.append([k, a, b])
    for k, a, b in merged:
        out += [text[at:a], f"<{k}>"]
        at = b
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with secrets masked; the length column, if there is one, follows the text."""
    at, names = docs.columns.index(text_col), docs.columns
    schema = T.StructType(docs.schema.fields)

    def run(batches):
        for whole in batches:
            for first in range(0, len(whole), 512):
                b = whole.slice(first, 512)
                text = pa.array([None if x.as_py() is None else mask(x.as_py()) for x in b.column(at)], pa.string())
                yield pa.RecordBatch.from_arrays([text if i == at else c for i, c in enumerate(b.columns)], names=names)
        give_back()

    out = docs.mapInArrow(run, schema)
    if length_col in names:
        out = out.withColumn(length_col, F.when(F.col(text_col).isNotNull(), F.length(text_col).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col)))
    return out

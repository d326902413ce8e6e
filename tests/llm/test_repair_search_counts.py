"""Conversation repair, lexical search and token counts against brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from math import floor, log

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tidemark.llm import queries as Q
from tidemark.llm import repair as R
from tidemark.llm.lexical import best, lexical_search, terms_of
from tidemark.llm.token_counts import MergeCounter, token_counts

from .test_operators import AWKWARD, awkward, empty  # noqa: F401

# token counts

WORD = public_tokenizers.path("word_bpe_49k.json")
LETTERS = [*"abAB'sz ., 12\t\n\r\x0b\x0c\x1c\x85 éßİΣςÅ가각ᄀ中̣́\U0001f600<|>endoftext​　", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'re"]


def test_counts_equal_the_library_on_drawn_texts():
    library, own, r = Tokenizer.from_file(WORD), MergeCounter(WORD), random.Random(5)
    for _ in range(4000):
        text = "".join(r.choice(LETTERS) for _ in range(r.randint(0, 14)))
        assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_a_long_word_is_merged_in_one_go():
    library, own = Tokenizer.from_file(WORD), MergeCounter(WORD)
    r = random.Random(6)
    word = "".join(r.choice("etaoinshr") for _ in range(30_000))
    assert own.count(word) == len(library.encode(word, add_special_tokens=False).ids)
    assert own.count("ab" * 300_000) == 300_000


def test_files_of_another_kind_are_refused():
    with pytest.raises(ValueError, match="not supported"):
        MergeCounter(public_tokenizers.path("byte_bpe_50k.json"))


def test_token_counts_of_documents(spark, sf):
    library = Tokenizer.from_file(WORD)
    texts = {x["doc_id"]: x["text"] or "" for x in pq.read_table(f"{sf}/documents.parquet").to_pylist()}
    found = {r.doc_id: r for r in Q.op13_token_counts(spark, sf).collect()}
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (found[i].n_bytes, found[i].n_tokens, found[i].over_limit) == (len(text.encode()), n, n > 2048)


def test_token_counts_of_awkward_rows(spark, awkward, empty):  # noqa: F811
    library = Tokenizer.from_file(WORD)
    want = sorted((i is not None, i or 0, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in AWKWARD)
    got = token_counts(awkward, WORD).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got) and any(r.over_limit for r in got)
    assert token_counts(empty, WORD).count() == 0


# lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def ranked(docs, items, k=10):
    """docs, items: lists of (id, text). Rows (item, rank, doc, score), by the formula."""
    bags = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs if t is not None]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    count, total = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(TERM.findall(lower(t or "")))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, b, n in bags:
            m = 100 - 90 + (90 * n * count) // total
            s = sum(floor(1000 * log((2 * count + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * b[t]) // (1000 * b[t] + 8 * m)) for t in terms if t in b)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return out


def told(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_terms_in_parts_are_the_terms_of_the_whole(monkeypatch):
    text = "Ab,cÄ-9 z" * 50 + "é" * 40 + ".Q"
    whole = [t for x in terms_of(text.encode()) for t in x]
    assert [t.decode() for t in whole] == TERM.findall(lower(text))
    monkeypatch.setattr("tidemark.llm.lexical.STEP", 7)
    assert [t for x in terms_of(text.encode()) for t in x] == whole


def test_best_takes_the_first_of_equal_scores():
    r = np.random.default_rng(3)
    for _ in range(300):
        s = r.integers(0, 4, r.integers(1, 40))
        want = sorted((i for i in range(len(s)) if s[i] > 0), key=lambda i: (-s[i], i))[:5]
        assert best(s, 5).tolist() == want


def test_search_equals_the_formula(spark, sf):
    docs = [(x["doc_id"], x["text"]) for x in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    items = [(x["item_id"], x["text"]) for x in pq.read_table(f"{sf}/benchmark.parquet").to_pylist()]
    assert told(Q.op12_lexical_search(spark, sf)) == sorted(ranked(docs, items), key=str)


def test_search_in_many_shards_and_blocks(spark, sf):
    d, b = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    assert told(lexical_search(d, b, shard_terms=3000, block_terms=100)) == told(Q.op12_lexical_search(spark, sf))


def test_search_of_awkward_rows(spark, awkward, empty):  # noqa: F811
    ddl = "item_id long, text string, term string, impacts string, score string"
    items = [(1, "a b C"), (1, "word7 zzz"), (2, None), (3, ""), (4, "..."), (None, "é x ß"), (5, "id"), (6, "a a a"), (7, "password")]
    table = spark.createDataFrame([(i, t, "q", "w", "z") for i, t in items], ddl)
    for k in (1, 2, 10):
        assert told(lexical_search(awkward, table, k)) == sorted(ranked(AWKWARD, items, k), key=str)
    tied = [(i % 9, "same words here") for i in range(40)] + [(None, "same words here")]
    many = spark.createDataFrame(tied, "doc_id long, text string").repartition(7)
    asked = spark.createDataFrame([(1, "words")], "item_id long, text string")
    assert told(lexical_search(many, asked, 6, shard_terms=10)) == sorted(ranked(tied, [(1, "words")], 6), key=str)
    assert lexical_search(empty, table).count() == 0
    assert lexical_search(awkward, table.limit(0)).count() == 0


def test_search_sql_says_the_same(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(Q.LEXICAL_SQL).fetchall()
    assert told(Q.op12_lexical_search(spark, sf)) == sorted(want, key=str)


# conversation repair


def cheapest(rows):
    """rows: (initial, must go, truncated). Least cost, then least letters, with what is done: by a fold over all states."""
    insert = {"": "u", "s": "u", "u": "a", "a": "u"}
    stands = {"": "su", "s": "u", "u": "a", "a": "u"}
    at_end = {"": (0, "", ()), "a": (0, "", ()), "u": (3, "I", ("+a",)), "s": (6, "II", ("+u", "+a"))}
    best = dict(at_end)
    for initial, must, cut in reversed(rows):
        own = {}
        for s in insert:
            ways, before, at = [], (), s
            for k in range(4):
                c, a, o = best[at]
                ways.append((3 * k + 4 + c, "I" * k + "D" + a, (*before, None, *o)))
                if not must:
                    if initial in stands[at] and initial:
                        c, a, o = best[initial]
                        ways.append((3 * k + 3 * cut + c, "I" * k + "K" + a, (*before, "", *o)))
                    c, a, o = best[insert[at]]
                    ways.append((3 * k + 3 + 3 * cut + c, "I" * k + "R" + a, (*before, insert[at], *o)))
                at = insert[at]
                before = (*before, "+" + at)
            own[s] = min(ways, key=lambda w: w[:2])
        best = own
    return best[""]


def brute(rows):
    """rows: (conv_id, turn, role, text). What the query gives, by conversation."""
    groups = defaultdict(list)
    for c, t, r, x in rows:
        own, r, x = groups[c], " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        own += [(t, "user" if kind == 4 else r, x)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for c, own in groups.items():
        own.sort(key=lambda y: (y[0] is not None, y[0] or 0, y[1], hashlib.sha256(y[2].encode()).hexdigest()))
        seen, faults, state = set(), Counter(), []
        for _, role, text in own:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            state.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(state, state[1:], strict=False))
        cost, audit, done = cheapest(state)
        lines, left = [], iter(own)
        names = {"u": "user", "a": "assistant"}
        for x in done:
            if x is not None and x.startswith("+"):
                lines.append(names[x[1]] + ":")
                continue
            _, role, text = next(left)
            if x is not None:
                lines.append(f"{names[x] if x else role}:{text}")
        out[c] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def repaired(df):
    out = [(r.conv_id, (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)) for r in df.collect()]
    assert len(dict(out)) == len(out)
    return dict(out)


def drawn(seed, convs, turns):
    r = random.Random(seed)
    texts = ["", " ", "Yes.", "Yes.", "no", "What?\n", "Go! ", "é.", "cut off,", None, "long " * 50 + "."]
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "u", "s"]
    rows = []
    for c in [*range(convs), None]:
        for t in range(r.randint(0, turns)):
            rows.append((c, r.choice([t, t, t, t, t + 3, None]), r.choice(roles), r.choice(texts)))
    return rows


DDL = "conv_id long, turn long, role string, text string, uid string, part string, kind string, codes string"


def frame(spark, rows):
    return spark.createDataFrame([(*x, "q", "w", "e", "r") for x in rows], DDL)


def test_repair_equals_brute_force_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(x.values()) for x in pq.read_table(f"{sf}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    assert repaired(Q.op11_conversation_repair(spark, sf)) == brute(rows)


@pytest.mark.parametrize("width", [2, 5, 1024])
def test_repair_equals_brute_force_on_drawn_rows(spark, width):
    rows = drawn(width, 60, 14)
    assert repaired(R.repaired_conversations(frame(spark, rows).repartition(5), width=width)) == brute(rows)


def test_a_conversation_of_most_rows_is_cut_into_segments(spark):
    rows = [(7, t, ("user", "assistant", "system")[t % 7 % 3], f"text {t}" + "." * (t % 3)) for t in range(3000)] + drawn(9, 20, 6)
    assert repaired(R.repaired_conversations(frame(spark, rows).repartition(6), width=64)) == brute(rows)


def test_repeated_rows_and_no_rows(spark):
    rows = [(1, 0, "user", "same.")] * 50 + [(2, 5, "assistant", "Ok.")] * 2 + [(3, None, None, None)]
    dropped = next(c for c in range(10, 200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "gone."))
    found = repaired(R.repaired_conversations(frame(spark, rows), width=4))
    assert found == {**brute(rows), dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert R.repaired_conversations(frame(spark, rows).limit(0)).count() == 0


def test_segments_solved_together_equal_one_by_one():
    r = np.random.default_rng(4)
    codes = [bytes(r.choice([0, 1, 2, 3, 4, 5, 6, 9, 10], r.integers(1, 20)).tolist()) for _ in range(400)]
    ends, last = np.tile(R.AT_END, (len(codes), 1)), np.ones(len(codes), bool)
    edits, cost, _ = R.solve(codes, ends, np.zeros(len(codes), np.int64), last)
    for c, e, n in zip(codes, edits, cost.tolist(), strict=True):
        want = cheapest([("suax"[x & 3], bool(x & 4), bool(x & 8)) for x in c])
        assert (n, e[e > 0].tobytes().decode()) == want[:2]

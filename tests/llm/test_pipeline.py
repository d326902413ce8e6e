"""The corpus pipeline, stage by stage, against brute force on what each stage was given."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from pyspark.sql import functions as F

import corpus_pipeline as P

from .test_operators import AWKWARD, DDL, WORDS, components


@pytest.fixture(scope="module")
def steps(spark, sf, tmp_path_factory):
    out, docs = [], spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    out.append(docs.toPandas())
    for i, (name, stage) in enumerate(P.STAGES):
        path = f"{tmp_path_factory.mktemp('stages')}/{i}"
        done = stage(spark, docs, sf)
        if i < len(P.STAGES) - 1:
            assert done.columns == columns, name
        done.write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.toPandas())
    return out


def test_language_stage_keeps_clean_documents(steps):
    kept = set(steps[1].doc_id)
    assert all(not re.search(r"[^\W\d_]", t or "") for d, t in zip(steps[0].doc_id, steps[0].text, strict=True) if d not in kept)


def test_exact_stage(steps):
    groups = defaultdict(list)
    for d, t in zip(steps[1].doc_id, steps[1].text, strict=True):
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), d))
    assert sorted(steps[2].doc_id) == sorted(min(own)[1] for own in groups.values())


def shingle_set(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def jaccard_components(texts):
    sets = [shingle_set(t) for t in texts]
    return components(len(texts), lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))


def test_near_stage(steps):
    docs = sorted(zip(steps[2].doc_id, steps[2].text, strict=True))
    root = jaccard_components([t for _, t in docs])
    assert sorted(steps[3].doc_id) == [d for i, (d, _) in enumerate(docs) if root[i] == i]


def test_near_stage_on_edited_copies(spark, tmp_path):
    """Copies with a few words changed, chains of them, a passage that many share, repeated rows and null ids."""
    rng, docs = np.random.default_rng(6), []
    passage = [f"p{i}" for i in range(60)]
    for g in range(25):
        base = [f"w{x}" for x in rng.integers(0, 3_000, int(rng.integers(30, 260)))]
        base = passage + base if g % 3 == 0 else base
        for _ in range(int(rng.integers(1, 7))):
            words = list(base)
            for at in rng.integers(0, len(words), int(rng.integers(0, 1 + len(words) // 70))):
                words[at] = f"e{rng.integers(0, 9)}"
            docs.append((len(docs) + 1, " ".join(words)))
    docs += [(900, "x y"), (901, "X  y"), (902, " "), (903, None), (None, docs[0][1]), (904, docs[3][1]), (904, docs[3][1]), (905, "alone here"), (905, "alone too")]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/d")
    got = P.near(spark, spark.read.parquet(f"{tmp_path}/d"), str(tmp_path)).collect()
    order = sorted(docs, key=lambda x: (x[0] is None, x[0] or 0))
    root = jaccard_components([t for _, t in order])
    assert sorted((r.doc_id, r.text or "") for r in got) == sorted((d, t or "") for i, (d, t) in enumerate(order) if root[i] == i)
    assert len(got) < 0.6 * len(docs)


def test_near_stage_finds_copies_by_their_original(spark, tmp_path):
    """Copies edited each in its own places are like the original alone, not like one another."""
    rng, docs = np.random.default_rng(12), []
    for g in range(4):
        base = [f"g{g}w{x}" for x in rng.integers(0, 5_000, 300)]
        docs.append(" ".join(base))
        for i in range(50):
            words = list(base)
            for at in range(i * 5, 300, 60):
                words[at] = f"e{i}"
            docs.append(" ".join(words))
    rng.shuffle(docs)
    docs = list(enumerate(docs, 1))
    sets = [shingle_set(t) for _, t in docs]
    root = jaccard_components([t for _, t in docs])
    assert len(set(root)) == 4 and sum(len(a & b) < 0.8 * len(a | b) for a in sets[:20] for b in sets[:20]) > 300
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/d")
    got = P.near(spark, spark.read.parquet(f"{tmp_path}/d"), str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == [d for i, (d, _) in enumerate(docs) if root[i] == i]


@pytest.mark.parametrize("pairs", [40, 300, 1_200])
def test_near_stage_finds_pairs_that_share_a_passage_with_all(spark, tmp_path, pairs):
    """Every text has one long passage; a pair has a part of its own words in common, and is alike by that alone."""
    rng = np.random.default_rng(pairs)
    passage, docs = [f"p{i}" for i in range(200)], []
    for g in range(pairs):
        own = [f"g{g}w{i}" for i in range(32)]
        docs.append(" ".join(passage + own))
        docs.append(" ".join(passage + own[:16] + [f"h{g}w{i}" for i in range(16)]))
    sets = [shingle_set(t) for t in docs]
    like = lambda a, b: len(a & b) / len(a | b)
    assert like(sets[0], sets[1]) > 0.85 and like(sets[0], sets[2]) < 0.8 and like(sets[1], sets[3]) < 0.8
    order = rng.permutation(len(docs))
    spark.createDataFrame([(int(i) + 1, docs[i]) for i in order], "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/d")
    got = {r.doc_id for r in P.near(spark, spark.read.parquet(f"{tmp_path}/d"), str(tmp_path)).collect()}
    found = sum(2 * g + 2 not in got for g in range(pairs))
    assert all(2 * g + 1 in got for g in range(pairs)) and found >= 0.99 * pairs


def test_near_stage_on_templates_of_many_kinds(spark, tmp_path):
    """Texts out of shared passages of several lengths and own words, some of them edited copies: the same as brute force."""
    rng, docs = np.random.default_rng(31), []
    passages = [[f"q{p}w{i}" for i in range(int(rng.integers(40, 220)))] for p in range(4)]
    for _ in range(260):
        words = [w for p in rng.permutation(4)[: rng.integers(1, 3)] for w in passages[p]]
        words += [f"o{rng.integers(0, 4_000)}" for _ in range(int(rng.integers(0, 40)))]
        docs.append(words)
    for _ in range(240):
        words = list(docs[rng.integers(0, len(docs))])
        for at in rng.integers(0, len(words), int(rng.integers(0, 6))):
            words[at] = f"e{rng.integers(0, 50)}"
        docs.append(words)
    docs = [(i, " ".join(w)) for i, w in enumerate(docs, 1)]
    root = jaccard_components([t for _, t in docs])
    spark.createDataFrame(docs, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/d")
    got = sorted(r.doc_id for r in P.near(spark, spark.read.parquet(f"{tmp_path}/d"), str(tmp_path)).collect())
    want = [d for i, (d, _) in enumerate(docs) if root[i] == i]
    assert set(want) <= set(got) and len(got) - len(want) <= 0.01 * (len(docs) - len(want))


def test_near_stage_misses_no_pair(spark, monkeypatch):
    """One sample finds half of the pairs, and all texts share what fills the fronts of many: the rest must be found all the same."""
    import random

    from tidemark.llm import simhash

    monkeypatch.setattr(simhash, "CELL", 4)
    r = random.Random(3)
    word = lambda: "".join(r.choices("abcdefgh", k=6))
    passage, rows = [word() for _ in range(60)], []
    for i in range(60):
        own = [word() for _ in range(r.randint(3, 12))]
        for _ in range(r.randint(1, 3)):
            copy = passage + own
            if r.random() < 0.7:
                copy[-r.randint(1, 2)] = word()
            rows.append((len(rows), " ".join(copy)))
    got = {x.doc_id: x.stays for x in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), samples=1).collect()}
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    root = {i: i for i in sets}
    find = lambda i: i if root[i] == i else find(root[i])
    for i in sets:
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    size = Counter(find(i) for i in sets)
    assert {i: find(i) == i for i in sets if size[find(i)] > 1} == got
    assert len(size) > 5


def test_secret_stage(steps):
    from tidemark.llm.secrets import base_spans, mask

    assert dict(zip(steps[4].doc_id, steps[4].text, strict=True)) == {d: mask(t) for d, t in zip(steps[3].doc_id, steps[3].text, strict=True)}
    assert [len(t) for t in steps[4].text] == list(steps[4].n_chars)
    assert not any(base_spans(t) for t in steps[4].text)


def test_packing_stage(steps):
    assert set(steps[5].doc_id) == set(steps[4].doc_id)


def test_run_is_the_stages(spark, sf, steps):
    out = P.run(spark, sf)
    assert out.count() == len(steps[5])
    assert len(pq.read_table(f"{sf}/documents.parquet")) == len(steps[0])


def test_awkward_rows(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, "en" if i and i % 2 else "xx", "s", 1, "q", "w", "z") for i, t in AWKWARD], DDL)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    once = P.exact(spark, docs, str(tmp_path))
    assert once.count() == len({re.sub("[\x20\x09-\x0d]", "", t or "") for _, t in AWKWARD})
    names = ["_text_hash", "_lang", "row", "id", "hash", "stays"]
    clash = docs.select("*", *(F.lit(i).alias(n) for i, n in enumerate(names)))
    for stage in (P.language, P.exact, P.near, P.secrets):
        out = stage(spark, clash, str(tmp_path))
        assert out.columns == clash.columns and all([r[n] for n in names] == list(range(6)) for r in out.collect())
    P.run(spark, str(tmp_path)).count()
    assert P.near(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_near_stage_proposes_in_proportion_to_a_dense_group(spark, monkeypatch):
    """Many texts that are alike in pairs, but few of them like one lead: proposals follow the texts and not their pairs."""
    from tidemark.llm import simhash

    made, table = {}, simhash.Scratch.table

    def kept(self, df, name):
        made[name] = table(self, df, name)
        return made[name]

    monkeypatch.setattr(simhash.Scratch, "table", kept)
    base, rows = [f"b{i}" for i in range(104)], []
    for i in range(240):  # two edits each: alike if the edits lie near each other
        words, at = list(base), 10 + i * 80 // 240
        words[at], words[at + 4] = f"x{i}", f"y{i}"
        rows.append((i, " ".join(words)))
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), samples=1).collect()
    assert sum(x.stays for x in got) == 1 and len(got) == len(rows)
    assert sum(t.count() for name, t in made.items() if name.startswith("pairs-")) < 8 * len(rows)


def test_near_stage_has_one_python_worker_a_task(spark, tmp_path, monkeypatch):
    """Two Python functions in one task are two workers, which stay in an executor's memory for all stages after it."""
    from tidemark.llm.common import Scratch

    plans, table = [], Scratch.table
    monkeypatch.setattr(Scratch, "table", lambda self, df, name: (plans.append(df._jdf.queryExecution().sparkPlan().toString()), table(self, df, name))[1])
    base = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(i, " ".join([*base[: 36 + i % 4], f"x{i % 4}"])) for i in range(12)], "doc_id long, text string")
    assert P.near_duplicates(docs).count() == 12
    assert any("MapInArrow" in p for p in plans)
    for plan in plans:
        workers = 0
        for line in plan.splitlines():  # from the root down; a join's other side begins after a scan
            workers += bool(re.search("MapInArrow|ArrowEvalPython|MapGroups|CoGroups", line))
            assert workers < 2, plan
            if re.search("Scan|Join|Aggregate|MapGroups|CoGroups", line):
                workers = 0


def test_packing_cache_keeps_to_what_it_is_given():
    from tidemark.llm.queries import tokenizer
    from tidemark.llm.tokens import CHUNKS, WordEncoder

    assert P.CACHED < CHUNKS
    coder = WordEncoder.of(tokenizer("byte_bpe_50k.json"), 100)
    texts = [" ".join(f"w{i}x{j}" for j in range(20)) for i in range(60)]
    few, most = [], 0
    for t in texts:
        few.append(coder.packed(t))
        most = max(most, len(coder.chunks))
    coder.forget()
    coder = WordEncoder.of(tokenizer("byte_bpe_50k.json"))
    assert most <= 120 and few == [coder.packed(t) for t in texts] and len(coder.chunks) > 1_000
    coder.forget()

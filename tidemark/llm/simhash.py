"""SimHash near-dedup (operator 4): exact pairs at a small Hamming distance through vantage-point trees.

Distinct fingerprints are dealt into shards by a tree whose nodes hold a vantage point and a median distance: nearer ones
go left, farther ones right. Two fingerprints at most r bits apart lie at distances from a vantage point that differ by
at most r, so only those within r of the boundary go to both sides. Each shard splits its points the same way down to
small leaves and compares the pairs there. Shards hand on a star per local group, and the stars are joined to components.
The tree's first levels come from a bounded sample, those below them from a rule; it steers only how even the shards are,
never which pairs are found. A level hands on about 1.2 times its points, so that rows dealt grow as n to the power 1.26.

Cases: null or empty text has fingerprint zero and links like any other; texts of fewer words than a shingle are one
shingle; equal fingerprints are one node, however many rows have them; repeated rows and ids are kept; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, among, bitmap, give_back, narrowed, parts, two
from .components import components, local_roots
from .exact_dedup import FP_BITS, _answer, golomb_encode, owner_of

SEED = 42
SHARD = 2_000  # distinct fingerprints a shard should hold
SAMPLED = 14  # levels of the dealing tree that come from a sample: at most 2^14 nodes, so that it stays bounded
PER_LEAF = 32  # sampled fingerprints for each shard
LEAF = 192  # points that are compared pair by pair
BATCH = 1 << 15
SAMPLES = 12  # fingerprints of samples of a document's shingles
PARITIES = 1_024  # bits that tell how many members two sets do not share, at least
OWNED = 2_000_000  # keys in front of texts that a task holds and an owner answers for, about
TOGETHER = 20_000  # members of small groups that are compared in one task
CELL = 1_024  # members of a group that are compared with so many others at a time
FRONT = "pid long, u long, size long, keys binary, marks binary, owner int, n int, payload binary"
ORDERED = 50_000  # texts that tell which shingles are frequent, about
LONG = 5_000  # sets of shingles, or pairs of them, that are worth a task of their own
COUNTERS = 1 << 24  # of the sketch of how frequent shingles are, at most (32 MB)


def shingles(raw: bytes, words: int) -> np.ndarray:
    """XXH64 of every run of so many words; of the whole sequence if it is shorter; none without a word."""
    tokens = raw.lower().split()  # bytes: only A-Z change, only ASCII white space divides
    if not tokens:
        return np.empty(0, np.uint64)
    line = b" ".join(tokens)
    ends = np.cumsum([len(x) + 1 for x in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k, digest = min(words, len(tokens)), xxhash.xxh64_intdigest
    del tokens
    starts, ends = starts[: len(starts) - k + 1], ends[k - 1 :]
    out = np.empty(len(starts), np.uint64)
    for i in range(0, len(out), BATCH):  # in parts, so that a very long text does not stand in memory as so many numbers
        out[i : i + BATCH] = [digest(line[a:b], SEED) for a, b in zip(starts[i : i + BATCH].tolist(), ends[i : i + BATCH].tolist(), strict=True)]
    return out


def majority(h: np.ndarray) -> int:
    """A bit is set if it is in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def simhash(raw: bytes, words: int = 3) -> int:
    return majority(shingles(raw, words))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """doc_id, text_hash (XXH64 of the text as it is) and fp, the 64 bits as a signed long."""

    def run(batches):
        for b in batches:
            fp = np.array([simhash(x, words) for x in b.column("raw").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(fp.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    return two(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("raw")).mapInArrow(run, "doc_id long, text_hash long, fp long")


def build_tree(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and median distances of nodes 1..2^depth-1, in heap order. The vantage point comes out of the
    node's own sample, so that a dense ball is split by distances within it."""
    points, median = np.zeros(1 << depth, np.uint64), np.full(1 << depth, 64, np.uint8)
    held, rng = {1: sample}, np.random.default_rng(7)
    for node in range(1, 1 << depth):
        own = held.pop(node, sample[:0])
        if len(own) > 1:
            points[node] = own[rng.integers(len(own))]
            d = np.bitwise_count(own ^ points[node])
            median[node] = max(1, int(np.median(d)))
            held[2 * node], held[2 * node + 1] = own[d <= median[node]], own[d > median[node]]
    return points, median


def ruled_points(node: np.ndarray) -> np.ndarray:
    """Vantage points of nodes below the sampled levels: any will do that differ from node to node, so a mix of its number."""
    x = node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def route(fp: np.ndarray, points: np.ndarray, median: np.ndarray, depth: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes into fp and the shard of each; those within reach of a boundary go to both sides."""
    at, node = np.arange(len(fp)), np.ones(len(fp), np.int64)
    for _ in range(depth):
        if len(node) and node[0] < len(points):
            point, m = points[node], median[node].astype(np.int16)
        else:
            point, m = ruled_points(node), np.int16(32)
        d = np.bitwise_count(fp[at] ^ point).astype(np.int16)
        left, right = d <= m, d > m - radius
        at, node = np.concatenate([at[left], at[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])
    return at, node - (1 << depth)


def close_pairs(fp: np.ndarray, radius: int):
    """All pairs at most radius bits apart, as arrays of indexes; a pair may come more than once."""
    rng, todo = np.random.default_rng(11), [np.arange(len(fp))]
    while todo:
        own = todo.pop()
        if len(own) > LEAF:
            for _ in range(4):
                d = np.bitwise_count(fp[own] ^ fp[own[rng.integers(len(own))]]).astype(np.int16)
                m = int(np.median(d))
                left, right = own[d <= m], own[d > m - radius]
                if max(len(left), len(right)) <= 0.85 * len(own):
                    todo += [left, right]
                    break
            else:  # too dense for its boundaries: compare in blocks
                for i in range(0, len(own), 256):
                    a, b = own[i : i + 256], own[i:]
                    for j in range(0, len(b), 4096):
                        x, y = np.nonzero(np.bitwise_count(fp[a][:, None] ^ fp[b[j : j + 4096]][None, :]) <= radius)
                        yield a[x], b[j : j + 4096][y]
            continue
        x, y = np.nonzero(np.bitwise_count(fp[own][:, None] ^ fp[own][None, :]) <= radius)
        yield own[x[x < y]], own[y[x < y]]


def _shard(radius: int):
    def run(group: pa.Table) -> pa.Table:
        rep, fp = group.column("rep").to_numpy(), group.column("fp").to_numpy().view(np.uint64)
        order = np.argsort(rep, kind="stable")
        rep, fp = rep[order], fp[order]
        us, vs, held = [], [], 0
        root = np.arange(len(fp))

        def fold():
            return local_roots(len(fp), np.concatenate([np.arange(len(fp)), *us]), np.concatenate([root, *vs]))

        for u, v in close_pairs(fp, radius):
            us.append(u), vs.append(v)
            held += len(u)
            if held > 2_000_000:  # a dense shard: keep what the pairs join, not the pairs
                root, us, vs, held = fold(), [], [], 0
        root = fold()
        told = root != np.arange(len(fp))
        return pa.table({"u": pa.array(rep[told]), "v": pa.array(rep[root[told]])})

    return run


def near_groups(prints: DataFrame, radius: int = 2, shard: int = SHARD, sampled: int = SAMPLED) -> DataFrame:
    """prints(doc_id, text_hash, fp), a stored table: adds component_id, the smallest id reachable over links of at most radius bits."""
    spark = prints.sparkSession
    scratch = Scratch(spark, "simhash")
    rows = prints.count()
    nodes = scratch.table(narrowed(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), rows), "nodes")
    n = nodes.count()
    depth = max(0, math.ceil(math.log2(max(1, n / shard))))
    share = min(1.0, 1.2 * PER_LEAF * 2 ** min(depth, sampled) / max(1, n))
    picked = nodes.where(F.pmod(F.xxhash64("fp", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30))).select("fp").collect() if depth else []
    points, median = build_tree(np.sort(np.array([x[0] for x in picked], np.int64)).view(np.uint64), min(depth, sampled))
    tree = spark.sparkContext.broadcast((points, median))  # at most 2^SAMPLED nodes of 9 bytes

    def deal(batches):
        points, median = tree.value
        for b in batches:
            at, to = route(b.column("fp").to_numpy().view(np.uint64), points, median, depth, radius)
            at = pa.array(at)
            yield pa.RecordBatch.from_arrays([pa.array(to), b.column("rep").take(at), b.column("fp").take(at)], names=["shard", "rep", "fp"])

    dealt = nodes.where("rep is not null").mapInArrow(deal, "shard long, rep long, fp long")
    links = dealt.groupBy("shard").applyInArrow(_shard(radius), "u long, v long")
    roots = components(links, scratch, rows=n)
    named = narrowed(nodes.join(scratch.shuffled(roots), nodes.rep == roots.node, "left").select("fp", F.coalesce("root", "rep").alias("component_id")), n)
    return prints.join(scratch.shuffled(scratch.table(named, "named")), "fp").select("doc_id", "text_hash", "fp", "component_id")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = Scratch(docs.sparkSession, "prints").table(fingerprints(docs, id_col, text_col, words), "prints")
    return near_groups(prints, radius).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def sample_prints(u: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """SimHashes of samples: the three shingles that come first under each of so many permutations. Two documents of Jaccard
    similarity J have about J^3 of them in common, bit by bit."""
    if len(u) < 3:
        u = np.resize(u, 3)
    turns = np.arange(1, samples + 1, dtype=np.uint64)
    return np.concatenate([_samples_of(u, x[:, None]) for x in np.array_split(turns, samples if len(u) > BATCH else 1)])


def _samples_of(u: np.ndarray, turn: np.ndarray) -> np.ndarray:
    p = ((u[None, :] ^ (turn * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)) ^ turn
    a, b, c = np.take_along_axis(np.broadcast_to(u, p.shape), np.argpartition(p, 2, axis=1)[:, :3], 1).T
    return ((a & b) | (a & c) | (b & c)) ^ (turn[:, 0] * np.uint64(0xA0761D6478BD642F))  # majority; told apart by turn


def _counter(h: np.ndarray, counters: int) -> np.ndarray:
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - counters.bit_length())).astype(np.int64)


def shingle_counts(spelt: DataFrame, most: int = COUNTERS) -> np.ndarray:
    """spelt(shingles: binary): how many sets hold a shingle, at least so many as do, in counters that shingles share by hash:
    four for each shingle, or `most`. Added up in Spark by blocks; the order they give is one order, however full they are."""
    total = int(spelt.agg(F.sum(F.octet_length("shingles"))).first()[0] or 0) // 8
    counters = min(most, 1 << max(16, (4 * total).bit_length()))
    step, top = 1 << 15, np.iinfo(np.uint16).max

    def count(batches):
        own = np.zeros(counters, np.uint32)
        for b in batches:
            for x in b.column("shingles"):
                x = np.frombuffer(x.as_py(), np.uint64)
                for i in range(0, len(x), 1 << 20):
                    np.add.at(own, _counter(x[i : i + (1 << 20)], counters), 1)
        for i in range(0, counters, step):
            if own[i : i + step].any():
                yield pa.RecordBatch.from_arrays([pa.array([i // step], pa.int32()), pa.array([np.minimum(own[i : i + step], top).astype("<u2").tobytes()], pa.binary())], names=["block", "counts"])

    def add(blocks: pa.Table) -> pa.Table:
        own = np.zeros(step, np.uint32)
        for x in blocks.column("counts"):
            own = np.minimum(own + np.frombuffer(x.as_py(), "<u2"), top)
        return pa.table({"block": blocks.column("block").slice(0, 1), "counts": pa.array([own.astype("<u2").tobytes()], pa.binary())})

    told = spelt.select("shingles").mapInArrow(count, "block int, counts binary").groupBy("block").applyInArrow(add, "block int, counts binary").toArrow()  # 2 * COUNTERS bytes at most
    out = np.zeros(counters, np.uint16)
    for block, x in zip(told.column("block").to_pylist(), told.column("counts"), strict=True):
        out[block * step : (block + 1) * step] = np.frombuffer(x.as_py(), "<u2")
    return out


def parities(h: np.ndarray) -> bytes:
    """Whether an odd number of the hashes fall to each of PARITIES places. Of two sets, no more of these differ than the
    sets have members that the other lacks."""
    return np.packbits(np.bincount((h >> np.uint64(7)).astype(np.int64) % PARITIES, minlength=PARITIES) & 1).tobytes()


def near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8, radius: int = 2, samples: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of every group of more than one document: doc_id, text_hash, stays. Documents are linked if their sets of
    shingles have a Jaccard similarity of at least `similarity`; of those that links join, the smallest id stays (null ids
    last, then the smallest text hash).

    A whole document's fingerprint moves by about ten bits at a similarity of 0.8, where a vantage-point tree prunes
    nothing; so the tree finds what lies within `radius` bits, and fingerprints of samples, equal bit by bit, find the
    rest: at 0.8 one pair in three thousand shares none of twelve. Within a group of equal samples the lead is the
    member whose samples reach most others (the text that the others are copies of), and every text is first proposed to
    the widest lead of its groups.

    What these have not joined is found by an exact pass over all texts (`rest`): every shingle in front of a text is a key,
    in an order that puts those last that a sample of the texts tells to be frequent; two sets of the similarity s have one
    in common among the first (1-s) of each. Keys go to owners as Golomb-Rice coded fingerprints, and only those that more
    than one text has come back as rows. All pairs of a key's texts are looked at that are not joined yet; those are
    proposed whose sizes, places of the key and parities (a bound on what sets do not share) allow the similarity, at first
    one for each text of a key, and when those have joined what they do, all. Large groups are compared in cells of `CELL`
    by `CELL`, so that no task holds one. Every proposal is settled on the two sets of shingles, so no link is wrong, and
    none is missed.

    Texts without a word are alike; equal texts are one node."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    rows = two(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))

    def sets(raw: bytes) -> np.ndarray:
        return np.unique(shingles(raw, words)) if raw.strip() else np.zeros(1, np.uint64)

    def sketch(batches):
        for b in batches:
            out = [(majority(u := sets(x.as_py())), len(u), sample_prints(u, samples).view(np.int64)) for x in b.column("raw")]
            u = None
            fp = pa.array(np.array([x[0] for x in out], np.uint64).view(np.int64))
            keys = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * samples), pa.array(np.concatenate([np.empty(0, np.int64), *(x[2] for x in out)])))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), fp, pa.array([x[1] for x in out], pa.int64()), keys], names=["doc_id", "text_hash", "fp", "size", "keys"])
        give_back()

    raw = rows.select("doc_id", "text_hash", F.col("text").cast("binary").alias("raw"))
    prints = scratch.table(raw.mapInArrow(sketch, "doc_id long, text_hash long, fp long, size long, keys array<long>"), "prints")
    total = prints.count()
    keyed = prints.select(F.col("text_hash").alias("u"), "size", F.explode("keys").alias("key")).distinct()
    keyed = scratch.table(narrowed(keyed, samples * total), "keyed")
    many = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    many = scratch.table(narrowed(many, samples * total), "many")
    members = scratch.table(narrowed(keyed.join(scratch.shuffled(many), "key"), samples * total), "members")
    scratch.forget("keyed", "many")
    reach = scratch.table(narrowed(members.groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("reach")), total), "reach")
    reached = members.join(scratch.shuffled(reach), F.col("u") == F.col("node")).select("key", "n", "u", "size", "reach")
    reached = scratch.table(narrowed(reached, samples * total), "reached")
    scratch.forget("members", "reach")
    near = near_groups(prints.select(F.col("text_hash").alias("doc_id"), "text_hash", "fp"), radius).select(F.col("doc_id").alias("u"), F.col("component_id").alias("v")).where("u <> v")
    near = scratch.table(narrowed(narrowed(near, total).distinct(), total), "near")

    def spelling(marks=None):
        """Of the texts, or of those that a bitmap tells to be possible."""

        def spell(batches):
            for b in batches:
                for i in range(0, len(b), 512):
                    part = b.slice(i, 512)
                    if marks is not None:
                        part = part.filter(pa.array(among(marks.value, part.column("hash").to_numpy())))
                    yield pa.RecordBatch.from_arrays([part.column("hash"), pa.array([sets(x.as_py()).tobytes() for x in part.column("raw")], pa.binary())], names=["hash", "shingles"])
            give_back()

        return spell

    def settle(batches):
        for b in batches:
            linked = []
            for x, y in zip(b.column("a"), b.column("b"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(common >= similarity * (len(x) + len(y) - common))
            yield b.select(["u", "v"]).filter(pa.array(linked, pa.bool_()))

    def settled(proposals: DataFrame, name: str) -> DataFrame:
        """Of the proposals those whose sets are alike; only texts that are named are spelt."""
        pairs = scratch.table(proposals.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), f"pairs-{name}")
        n = pairs.count()
        named = scratch.table(narrowed(pairs.select(F.col("u").alias("hash")).union(pairs.select("v")).distinct(), min(2 * n, total)), f"named-{name}")
        marks = bitmap(named)
        marks = None if marks is None else spark.sparkContext.broadcast(marks)  # 64 MB at most
        found = raw.select(F.col("text_hash").alias("hash"), "raw").mapInArrow(spelling(marks), "hash long, shingles binary")
        asked = found.join(scratch.shuffled(named), "hash", "left_semi").dropDuplicates(["hash"])
        asked = scratch.table(narrowed(asked, min(2 * n, total), LONG), f"spelt-{name}")
        both = pairs.join(scratch.shuffled(asked.select(F.col("hash").alias("u"), F.col("shingles").alias("a"))), "u").join(scratch.shuffled(asked.select(F.col("hash").alias("v"), F.col("shingles").alias("b"))), "v")
        links = scratch.table(narrowed(both, n, LONG).select("u", "v", "a", "b").mapInArrow(settle, "u long, v long"), f"links-{name}")
        scratch.forget(f"pairs-{name}", f"named-{name}", f"spelt-{name}")
        return links

    def proposed(members: DataFrame, leads: list, name: str) -> DataFrame:
        """Every member of a group with each lead of it, where sizes allow the similarity and labels differ."""
        led = members.groupBy("key").agg(F.array_distinct(F.array(*leads)).alias("leads"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        led = scratch.table(narrowed(led.select("key", F.explode("leads").alias("v")), samples * total), f"leads-{name}")
        told = narrowed(members.join(scratch.shuffled(led), "key"), samples * total).where((F.col("label") != F.col("v.label")) & (F.least("size", "v.size") >= similarity * F.greatest("size", "v.size")))
        return told.select("u", F.col("v.u").alias("v"), F.col("v.reach").alias("v_reach"))

    def rest(links: DataFrame) -> DataFrame:
        """links, and what they lack: pairs of texts that are not joined, that share a key in front and that size, place and parities allow."""
        texts = raw.select(F.col("text_hash").alias("hash"), "raw")
        keys = prints.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        some = texts.where(F.pmod("hash", F.lit(max(1, total // ORDERED))) == 0).mapInArrow(spelling(), "hash long, shingles binary")
        counts = shingle_counts(scratch.table(some, "some"))
        scratch.forget("some")
        shared = spark.sparkContext.broadcast(counts)  # COUNTERS at most
        owners = max(parts(spark), int((1 - similarity) * keys) // OWNED)

        def front(batches):
            """A row for each text, and for each chunk of them a message to every owner of keys."""
            chunk, seen, held = TaskContext.get().partitionId() << 32, [], 0

            def messages() -> pa.RecordBatch:
                own = np.unique(np.concatenate(seen))
                cuts = np.searchsorted(owner_of(own, owners), np.arange(owners + 1))
                to = np.flatnonzero(np.diff(cuts))
                n = len(to)
                return pa.RecordBatch.from_arrays([pa.array([chunk] * n, pa.int64()), *(pa.nulls(n, k) for k in (pa.int64(), pa.int64(), pa.binary(), pa.binary())), pa.array(to.astype(np.int32)), pa.array(np.diff(cuts)[to].astype(np.int32)), pa.array([golomb_encode(own[cuts[o] : cuts[o + 1]]) for o in to], pa.binary())], names=names)

            names = [x.split()[0] for x in FRONT.split(", ")]
            for b in batches:
                for i in range(0, len(b), 256):
                    part = b.slice(i, 256)
                    keys, sizes, marks = [], [], []
                    for x in part.column("raw"):
                        x = sets(x.as_py())
                        n = shared.value[_counter(x, len(shared.value))]
                        keys.append((x[np.lexsort((x, n))[: len(x) - math.ceil(similarity * len(x) - 1e-9) + 1]] >> np.uint64(64 - FP_BITS)).astype(np.int64))
                        sizes.append(len(x)), marks.append(parities(x))
                    k = len(part)
                    yield pa.RecordBatch.from_arrays([pa.array([chunk] * k, pa.int64()), part.column("hash"), pa.array(sizes, pa.int64()), pa.array([x.view(np.uint8).reshape(-1, 8)[:, : FP_BITS // 8].tobytes() for x in keys], pa.binary()), pa.array(marks, pa.binary()), *(pa.nulls(k, t) for t in (pa.int32(), pa.int32(), pa.binary()))], names=names)
                    seen.append(np.unique(np.concatenate(keys)))
                    held += len(seen[-1])
                    if held > OWNED:
                        yield messages()
                        chunk, seen, held = chunk + 1, [], 0
            if seen:
                yield messages()
            give_back()

        def met_again(fronts: pa.Table, answers: pa.Table) -> pa.Table:
            """A chunk: the places of its keys that another of its texts or another chunk has."""
            own = [np.frombuffer(x.as_py(), np.uint8).reshape(-1, FP_BITS // 8) for x in fronts.column("keys")]
            sizes = np.array([len(x) for x in own], np.int64)
            key = np.zeros((int(sizes.sum()), 8), np.uint8)
            key[:, : FP_BITS // 8] = np.concatenate([np.empty((0, FP_BITS // 8), np.uint8), *own])
            key = key.view("<i8").ravel()
            every, back, times = np.unique(key, return_inverse=True, return_counts=True)
            answers = answers.sort_by("owner")
            bits = [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(answers.column("bits").to_pylist(), answers.column("n").to_pylist(), strict=True)]
            at = np.flatnonzero((np.concatenate([np.empty(0, np.uint8), *bits]).astype(bool) | (times > 1))[back])
            row = np.repeat(np.arange(len(sizes)), sizes)[at]
            pos = at - (np.cumsum(sizes) - sizes)[row]
            return pa.table({"key": key[at], "u": fronts.column("u").to_numpy()[row], "size": fronts.column("size").to_numpy()[row], "pos": pos.astype(np.int32)})

        def comparing(least_apart: bool):
            """Groups of keys, or two cells of one key. least_apart: of a text's pairs in a group only that whose parities differ least."""

            def compare(group: pa.Table) -> pa.Table:
                key, u, size, pos, label, cell = (group.column(c).to_numpy() for c in ("key", "u", "size", "pos", "label", "cell"))
                marks = np.frombuffer(b"".join(group.column("marks").to_pylist()), np.uint64).reshape(len(u), -1)
                one, order = group.column("a")[0].as_py() == group.column("b")[0].as_py(), np.lexsort((u, key))
                cuts = np.flatnonzero(np.diff(key[order], prepend=key[order[:1]] - 1, append=key[order[-1:]] + 1))
                found = np.empty((0, 2), np.int64)
                for own in (order[p:q] for p, q in zip(cuts[:-1], cuts[1:], strict=True)):
                    for i in range(0, len(own), 256):
                        x, y = own[i : i + 256, None], own[None, i:]
                        least = np.minimum((size - pos)[x], (size - pos)[y])  # what the two have in common from their first common key on
                        common = similarity / (1 + similarity) * (size[x] + size[y])
                        at, to = np.nonzero((u[x] < u[y]) & (label[x] != label[y]) & ((cell[x] != cell[y]) | one) & (least + 1e-9 >= common))
                        x, y = x[at, 0], y[0, to]
                        most = size[x] + size[y] - 2 * np.ceil(common[at, to] - 1e-9).astype(np.int64)
                        for j in range(0, len(x), 1 << 16):
                            a, b = x[j : j + (1 << 16)], y[j : j + (1 << 16)]
                            apart = np.bitwise_count(marks[a] ^ marks[b]).sum(1, dtype=np.int64)
                            near = np.flatnonzero(apart <= most[j : j + (1 << 16)])
                            if least_apart:
                                near = near[np.lexsort((b[near], apart[near]))]
                                near = np.concatenate([near[np.unique(a[near], return_index=True)[1]], near[np.unique(b[near], return_index=True)[1]]])
                            found = np.concatenate([found, np.stack([u[a[near]], u[b[near]]], 1)])
                found = np.unique(found, axis=0) if len(found) else found
                return pa.table({"u": found[:, 0], "v": found[:, 1]})

            return compare

        sent = scratch.table(texts.mapInArrow(front, FRONT), "fronts")
        answers = sent.where("payload is not null").select("pid", "owner", "n", "payload").groupBy("owner").applyInArrow(_answer, "pid long, owner int, n int, bits binary")
        plain = sent.where("payload is null")
        met = plain.select("pid", "u", "size", "keys").groupBy("pid").cogroup(answers.groupBy("pid")).applyInArrow(met_again, "key long, u long, size long, pos int").distinct()
        met = scratch.table(met, "met")
        n = met.count()
        for turn, best in (("best", True), ("rest", False)):  # first a pair for each text, so that few are left to the pass over all
            steps = Scratch(spark, f"near-{turn}")
            own = scratch.shuffled(scratch.table(components(links, steps, rows=links.count()), f"joined-{turn}"))
            steps.drop()
            labelled = met.join(own, F.col("u") == F.col("node"), "left").select("key", "u", "size", "pos", F.coalesce("root", "u").alias("label"))
            labelled = scratch.table(narrowed(labelled, n), f"{turn}-members")
            unsettled = labelled.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
            unsettled = scratch.table(narrowed(unsettled.select("key", "n", F.ceil(F.col("n") / CELL).alias("cells")), n), f"{turn}-open")
            held, copied = unsettled.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") * F.col("cells")), F.lit(0))).first()
            compared = scratch.table(narrowed(labelled.join(scratch.shuffled(unsettled.drop("n")), "key"), n), f"{turn}-compared")
            compared = narrowed(compared.join(scratch.shuffled(plain.select(F.col("u").alias("text"), "marks").dropDuplicates(["text"])), F.col("u") == F.col("text")), copied)
            part = F.when(F.col("cells") > 1, F.col("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(held // TOGETHER + 1)))  # keys of few texts go together
            compared = compared.withColumn("part", part).withColumn("cell", F.pmod(F.xxhash64("u"), "cells"))
            compared = compared.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cells") - 1)))
            cells = compared.select("part", "key", F.least("cell", "other").alias("a"), F.greatest("cell", "other").alias("b"), "u", "size", "pos", "label", "cell", "marks")
            pairs = cells.groupBy("part", "a", "b").applyInArrow(comparing(best), "u long, v long")
            links = links.unionByName(settled(pairs, turn))
            scratch.forget(f"joined-{turn}", *(f"{turn}-{x}" for x in ("members", "open", "compared")))
        scratch.forget("fronts", "met")
        return links

    who = F.struct("u", "size", "label", "reach")
    far = F.max_by(who, F.struct("reach", "u"))  # the member whose samples reach most others
    begun = proposed(reached.withColumn("label", F.col("u")), [far], "first")
    begun = narrowed(begun.groupBy("u").agg(F.max_by("v", F.struct("v_reach", "v")).alias("v")), total)  # the widest lead of each text
    links = settled(begun.unionByName(near), "first")
    scratch.forget("reached", "near", "leads-first")
    links = rest(links)
    n = links.count()
    roots = components(links, scratch, rows=n)
    copies = prints.groupBy("text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("text_hash").alias("hash"))
    groups = links.select(F.explode(F.array("u", "v")).alias("hash")).union(copies).distinct()
    groups = groups.join(scratch.shuffled(roots), groups.hash == roots.node, "left").select("hash", F.coalesce("root", "hash").alias("label"))
    groups = scratch.table(narrowed(groups, total), "labels")
    own = prints.select("doc_id", "text_hash").join(scratch.shuffled(groups), F.col("text_hash") == F.col("hash")).select("doc_id", "text_hash", "label")
    own = scratch.table(narrowed(own, total), "own")
    best = own.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("best"))
    out = narrowed(own.join(scratch.shuffled(scratch.table(narrowed(best, total), "best")), "label"), total)
    return out.select("doc_id", "text_hash", (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))).alias("stays"))

"""Structure of conversations, and its repair at least cost (operator 11).

A conversation is sound if the initials of its roles are `(s?(ua)+)?`. The edits are: keep a row (free), set its role (3),
delete it (4; blank and repeated rows must go), insert an empty row (3); a row that breaks off costs 3 more unless it goes.

Rows are known by number and have one byte each (initial and fault) for the search. They are sorted by ranges of conversation
and turn, and what of a conversation stands in one range is cut into segments of at most `WIDTH` rows. Segments of like
length are bucketed and solved together, time-major: for every turn, from the last, one numpy step takes the costs of all
segments' four states on, and all are stored; then edits are traced for all segments together from the first turn, taking at
each step the least letter that still ends at the least cost. A conversation of one segment is done with that. One of more
takes three steps that hold 16 numbers a segment: the cost of each segment from each state to each, a fold over segments
from the last that gives the cost behind every segment, and the trace's exit from each state, followed from the first. So
no task holds the rows of a conversation. Its hash is taken from its sorted rows as they pass by, one batch in memory: that
one value cannot be divided, and a conversation of a third of all rows is one task's stream there.

Cases: any null counts as one space (a role or a text; the conversation and the turn in what is hashed for the damage; a null
conversation is one conversation, returned with a null id); null turns come first; rows of one turn stand by role, then by
SHA-256 of the text; repeated rows are duplicates where they follow their like; an empty text is blank; a role is known by
its first letter, and one that is not s, u or a cannot be kept; very long texts are hashed whole; a conversation without
rows has zeros, no edits and the empty text's hash; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, parts

WIDTH = 1024  # rows of a segment at most
BATCH = 4096  # segments that are solved together
SPACE = " \t\n\x0b\x0c\r"

START, SYSTEM, USER, ASSISTANT = range(4)  # what stands last
AFTER_INSERT = np.array([USER, USER, ASSISTANT, USER], np.int64)  # the one role that may be inserted there
NEVER = 1 << 40
AT_END = np.array([0, 6, 3, 0], np.int64)  # rows to insert where nothing follows
#: The state after a kept row of each initial (s, u, a, other); -1: it may not stand there.
AFTER_KEPT = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]], np.int64)
REROLE, DELETE, INSERT, BROKEN_OFF = 3, 4, 3, 3
MUST_GO, TRUNCATED, NO_ROW = 4, 8, 16  # added to the number of the initial
MATRIX = [f"c{i}{j}" for i in range(4) for j in range(4)]


def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text after the damage that the crc32 of `conv_id:turn` decides."""
    blank = F.lit(" ")
    rows = turns.select(F.col(f"`{conv}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role}`"), blank).alias("role"), F.coalesce(F.col(f"`{text}`"), blank).alias("text"))
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")) % 20
    rows = rows.withColumn("kind", kind).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


# the search


def _inserted(own: np.ndarray) -> np.ndarray:
    """Costs of the four states, where up to two rows may be inserted first."""
    once = own[:, AFTER_INSERT]
    return np.minimum(own, np.minimum(INSERT + once, 2 * INSERT + once[:, AFTER_INSERT]))


def _row_costs(code: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For one turn of all segments: costs on of deleting, keeping and setting the role, by state."""
    must, extra = (code & MUST_GO) > 0, np.where(code & TRUNCATED, BROKEN_OFF, 0)[:, None]
    to = AFTER_KEPT[:, code & 3].T
    keep = np.where((to < 0) | must[:, None], NEVER, extra + np.take_along_axis(behind, np.maximum(to, 0), 1))
    rerole = np.where(must[:, None], NEVER, REROLE + extra + behind[:, AFTER_INSERT])
    return DELETE + behind, keep, rerole


def backward(codes: np.ndarray, end: np.ndarray) -> np.ndarray:
    """codes[turn, segment]; end[segment, state]: the cost behind the last row. All costs [turn, segment, state]."""
    costs = np.empty((len(codes) + 1, *end.shape), np.int64)
    costs[-1] = end
    for t in range(len(codes) - 1, -1, -1):
        none = codes[t] >= NO_ROW
        own = np.minimum.reduce(_row_costs(codes[t] & 15, costs[t + 1]))
        costs[t] = np.where(none[:, None], costs[t + 1], _inserted(own))
    return np.minimum(costs, NEVER)


def forward(codes: np.ndarray, costs: np.ndarray, state: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Traces the cheapest edits, of equal ones the least letters. Gives [turn, segment, 3]: up to two inserted rows and the
    row's own edit, as letters or 0, with a turn after the last for what is inserted there where `last`; and the states
    that are reached."""
    every, state = np.arange(codes.shape[1]), state.copy()
    edits = np.zeros((len(codes) + 1, codes.shape[1], 3), np.uint8)
    for t, code in enumerate(codes):
        open_rows = code < NO_ROW
        remove, keep, rerole = _row_costs(code & 15, costs[t + 1])
        for slot in range(3):
            now = costs[t][every, state]
            if slot < 2:
                insert = open_rows & (remove[every, state] != now) & (INSERT + costs[t][every, AFTER_INSERT[state]] == now)
                edits[t, insert, slot] = ord("I")
                state = np.where(insert, AFTER_INSERT[state], state)
            else:
                gone = open_rows & (remove[every, state] == now)
                kept = open_rows & ~gone & (keep[every, state] == now)
                set_role = open_rows & ~gone & ~kept
                edits[t, :, 2] = np.select([gone, kept, set_role], [ord("D"), ord("K"), ord("R")], 0)
                state = np.where(kept, AFTER_KEPT[state, code & 3], np.where(set_role, AFTER_INSERT[state], state))
    for slot in range(2):
        insert = last & (AT_END[state] > 0)
        edits[-1, insert, slot] = ord("I")
        state = np.where(insert, AFTER_INSERT[state], state)
    return edits, state


def _buckets(codes: list[bytes]):
    """Segments of like length (to a power of two): their places, and the codes time-major."""
    size = np.array([len(c) for c in codes])
    level = np.ceil(np.log2(np.maximum(size, 1))).astype(int)
    for own in (np.flatnonzero(level == x) for x in np.unique(level)):
        grid = np.full((int(size[own].max()), len(own)), NO_ROW, np.int64)
        for i, at in enumerate(own):
            grid[: size[at], i] = np.frombuffer(codes[at], np.uint8)
        yield own, grid


def transfer(codes: list[bytes]) -> np.ndarray:
    """[segment, from, to]: the cost through a segment, from each state before it to each behind it."""
    out = np.empty((len(codes), 4, 4), np.int64)
    for own, grid in _buckets(codes):
        for to in range(4):
            end = np.full((len(own), 4), NEVER, np.int64)
            end[:, to] = 0
            out[own, :, to] = backward(grid, end)[0]
    return out


def solve(codes: list[bytes], end: np.ndarray, entry: np.ndarray, last: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Edits of each segment [turns + 1, 3], their cost, and the state behind it. end: the cost behind each segment."""
    edits, cost, behind = [None] * len(codes), np.empty(len(codes), np.int64), np.empty(len(codes), np.int64)
    for own, grid in _buckets(codes):
        costs = backward(grid, end[own])
        found, state = forward(grid, costs, entry[own], last[own])
        begun = costs[0][np.arange(len(own)), entry[own]]
        cost[own] = np.where(last[own], begun, begun - costs[-1][np.arange(len(own)), state])
        behind[own] = state
        for i, at in enumerate(own):
            n = len(codes[at])
            edits[at] = np.concatenate([found[:n, i], found[-1:, i]])
    return edits, cost, behind


# on Spark

SEGMENT = "cid string, part int, seg int, uids array<long>, codes binary, n int, blank long, duplicate long, truncated long, illegal long, first string, final string, low long, high long, turns long"


def _segments(rows: DataFrame, width: int) -> DataFrame:
    """rows, sorted within their partitions by conversation: what of one stands together, in segments of at most `width`."""
    names = [x.split()[0] for x in SEGMENT.split(", ")]
    types = {"string": pa.string(), "int": pa.int32(), "array<long>": pa.list_(pa.int64()), "binary": pa.binary(), "long": pa.int64()}
    schema = pa.schema([(x.split()[0], types[x.split()[1]]) for x in SEGMENT.split(", ")])
    legal, number, after = {"su", "ua", "au"}, {"s": 0, "u": 1, "a": 2}, {1: MUST_GO, 2: MUST_GO, 3: TRUNCATED}

    def run(batches):
        made, held, size, seq, last_cid = [], [], 0, 0, None

        def close():
            part, initials, turns = held[0][1], [r[4] for r in held], [r[3] for r in held if r[3] is not None]
            faults = [r[5] for r in held]
            code = bytes(number.get(i, 3) | after.get(f, 0) for i, f in zip(initials, faults, strict=True))
            illegal = sum(a + b not in legal for a, b in zip(initials, initials[1:], strict=False))
            made.append((held[0][0], part, seq, [r[2] for r in held], code, len(held), faults.count(1), faults.count(2), faults.count(3), illegal, initials[0], initials[-1], min(turns, default=None), max(turns, default=None), len(set(turns))))

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*made, strict=True), schema, strict=True)], names=names)

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("cid", "part", "uid", "turn", "initial", "fault")), strict=True):
                if held and (row[0] != last_cid or len(held) >= width):
                    close()
                    size += len(held)
                    seq = seq + 1 if row[0] == last_cid else 0
                    held = []
                    if size >= 16 * width:
                        yield batch()
                        made, size = [], 0
                elif row[0] != last_cid:
                    seq = 0
                last_cid = row[0]
                held.append(row)
        if held:
            close()
        if made:
            yield batch()

    return rows.mapInArrow(run, SEGMENT)


def _behind(segments: pa.Table) -> pa.Table:
    """The segments of one conversation, by 16 costs each: the costs behind each of them."""
    segments = segments.sort_by([("part", "ascending"), ("seg", "ascending")])
    through = np.stack([segments.column(c).to_numpy() for c in MATRIX], 1).reshape(-1, 4, 4)
    ends = np.empty((len(through), 4), np.int64)
    ends[-1] = AT_END
    for i in range(len(through) - 1, 0, -1):
        ends[i - 1] = np.minimum((through[i] + ends[i][None]).min(1), NEVER)
    last = np.arange(len(through)) == len(through) - 1
    return pa.table({"cid": segments.column("cid"), "part": segments.column("part"), "seg": segments.column("seg"), "last": pa.array(last), **{f"e{s}": pa.array(ends[:, s]) for s in range(4)}})


def _entries(segments: pa.Table) -> pa.Table:
    """The segments of one conversation, by the states behind them for each state before: the state before each."""
    segments = segments.sort_by([("part", "ascending"), ("seg", "ascending")])
    exits, state, entry = np.stack([segments.column(f"x{s}").to_numpy() for s in range(4)], 1), START, []
    for x in exits:
        entry.append(state)
        state = int(x[state])
    return pa.table({"cid": segments.column("cid"), "part": segments.column("part"), "seg": segments.column("seg"), "entry": pa.array(entry, pa.int32())})


def _told(f, names: list[str], types: list[pa.DataType]):
    """A function over batches of segments, a bounded number at a time: it adds columns to (cid, part, seg)."""

    def run(batches):
        for b in batches:
            for i in range(0, len(b), BATCH):
                part = b.slice(i, BATCH)
                out = f(part, part.column("codes").to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("cid", "part", "seg")), *(pa.array(x, t) for x, t in zip(out, types, strict=True))], names=["cid", "part", "seg", *names])

    return run


def _ends(part: pa.RecordBatch) -> np.ndarray:
    return np.stack([part.column(f"e{s}").to_numpy() for s in range(4)], 1)


def _matrices(part, codes):
    return transfer(codes).reshape(-1, 16).T


def _exits(part, codes):
    ends, last = _ends(part), np.zeros(len(codes), bool)
    return [solve(codes, ends, np.full(len(codes), s), last)[2] for s in range(4)]


def _traced(part, codes):
    """For each segment: its edits as letters, its cost, and what stands in place of every row: lines that are put before
    it, and its role if it stays (empty: as it was)."""
    entry, last = part.column("entry").to_numpy().astype(np.int64), part.column("last").to_numpy(zero_copy_only=False)
    edits, cost, _ = solve(codes, _ends(part), entry, last)
    audits, before, roles = [], [], []
    for own, state in zip(edits, entry.tolist(), strict=True):
        audits.append(own[own > 0].tobytes().decode())
        puts, sets, code = [], [], codes[len(audits) - 1]
        for t, (one, two, edit) in enumerate(own.tolist()):
            put = []
            for insert in (one, two):
                if insert:
                    state = int(AFTER_INSERT[state])
                    put.append("user:" if state == USER else "assistant:")
            role = None
            if edit == ord("K"):
                state, role = int(AFTER_KEPT[state, code[t] & 3]), ""
            elif edit == ord("R"):
                state = int(AFTER_INSERT[state])
                role = "user" if state == USER else "assistant"
            puts.append("\n".join(put)), sets.append(role)
        before.append(puts), roles.append(sets)
    return audits, cost, before, roles


def _hashes(batches):
    """Lines, sorted by conversation and place: the hash of each conversation's lines."""
    cid, digest, empty = None, None, True

    def done():
        return pa.RecordBatch.from_arrays([pa.array([cid], pa.string()), pa.array([digest.hexdigest()], pa.string())], names=["cid", "repaired_sha256"])

    for b in batches:
        for own, line in zip(b.column("cid").to_pylist(), b.column("line"), strict=True):
            if own != cid:
                if digest is not None:
                    yield done()
                cid, digest, empty = own, hashlib.sha256(), True
            digest.update((b"" if empty else b"\n") + line.as_py())
            empty = False
    if digest is not None:
        yield done()


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", width: int = WIDTH) -> tuple[DataFrame, DataFrame, Scratch]:
    """Of conversations as they are (no damage done): (cid, gaps, blank, duplicate, truncated, illegal, cost, audit) of each,
    and the repaired lines (cid, part, seg, at, line) in order. cid is the id as a string, a null being one space."""
    spark = turns.sparkSession
    scratch, n = Scratch(spark, "repair"), parts(spark)
    blank = F.lit(" ")
    rows = turns.select(F.coalesce(F.col(f"`{conv}`").cast("string"), blank).alias("cid"), F.col(f"`{turn}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role}`"), blank).alias("role"), F.coalesce(F.col(f"`{text}`"), blank).alias("text"))
    rows = scratch.table(rows.withColumn("uid", F.monotonically_increasing_id()), "rows")
    end = F.right(F.rtrim(F.col("text"), F.lit(SPACE)), F.lit(1))
    light = rows.select("cid", "turn", "uid", F.left("role", F.lit(1)).alias("initial"), "role", F.sha2("text", 256).alias("sha"), F.when(F.ltrim(F.col("text"), F.lit(SPACE)) == "", 1).when(~end.isin(".", "!", "?"), 3).otherwise(0).alias("fault"))
    light = scratch.table(light, "light")
    # the first row of each role and text in its conversation; by its number, so that no group of rows comes together
    first = light.groupBy("cid", "role", "sha").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn", "uid")).alias("m")).select(F.col("m.uid").alias("uid"), F.lit(True).alias("is_first"))
    light = light.join(first.hint("merge"), "uid", "left").withColumn("fault", F.when((F.col("fault") != 1) & F.col("is_first").isNull(), 2).otherwise(F.col("fault")))
    order = [F.col("cid"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha"), F.col("uid")]
    ranged = light.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    segments = scratch.table(_segments(ranged.select("cid", "part", "uid", "turn", "initial", "fault"), width), "segments")
    key = ["cid", "part", "seg"]

    # conversations of more than one segment: cut by width, or by the border of a range
    several = segments.groupBy("cid").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("cid")
    several = scratch.table(several, "several")
    codes = segments.select(*key, "codes")
    many = scratch.table(codes.join(several.hint("merge"), "cid", "left_semi"), "many")
    alone = codes.join(several.hint("merge"), "cid", "left_anti").select("*", F.lit(True).alias("last"), *(F.lit(int(x)).cast("long").alias(f"e{s}") for s, x in enumerate(AT_END)), F.lit(START).alias("entry"))
    long = pa.int64()
    through = many.mapInArrow(_told(_matrices, MATRIX, [long] * 16), "cid string, part int, seg int, " + ", ".join(f"{c} long" for c in MATRIX))
    behind = scratch.table(through.groupBy("cid").applyInArrow(_behind, "cid string, part int, seg int, last boolean, e0 long, e1 long, e2 long, e3 long"), "behind")
    ended = many.join(behind.hint("merge"), key)
    exits = ended.mapInArrow(_told(_exits, [f"x{s}" for s in range(4)], [long] * 4), "cid string, part int, seg int, x0 long, x1 long, x2 long, x3 long")
    entries = exits.groupBy("cid").applyInArrow(_entries, "cid string, part int, seg int, entry int")
    ready = alone.unionByName(ended.join(scratch.table(entries, "entries").hint("merge"), key).select(*alone.columns))
    traced = ready.mapInArrow(_told(_traced, ["audit", "cost", "before", "roles"], [pa.string(), long, pa.list_(pa.string()), pa.list_(pa.string())]), "cid string, part int, seg int, audit string, cost long, before array<string>, roles array<string>")
    traced = scratch.table(traced, "traced")

    follows = Window.partitionBy("cid").orderBy("part", "seg")
    seen = segments.drop("uids", "codes").join(traced.select(*key, "audit", "cost").hint("merge"), key)
    joint = F.lag("final").over(follows)
    seen = seen.withColumn("joint", F.when(joint.isNotNull() & ~F.concat(joint, "first").isin("su", "ua", "au"), 1).otherwise(0))
    seen = seen.withColumn("shared", F.when(F.max("high").over(follows.rowsBetween(Window.unboundedPreceding, -1)) == F.col("low"), 1).otherwise(0))
    gaps = F.coalesce(F.max("high") - F.min("low") + 1 - (F.sum("turns") - F.sum("shared")), F.lit(0))
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "seg", "audit"))), lambda x: x["audit"]), "")
    totals = seen.groupBy("cid").agg(gaps.cast("long").alias("gaps"), *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")), F.sum(F.col("illegal") + F.col("joint")).alias("illegal"), F.sum("cost").alias("cost"), audit.alias("audit"))

    # the lines, by the numbers of the rows; what is inserted behind the last row has no number
    placed = segments.select(*key, "uids").join(traced.select(*key, "before", "roles").hint("merge"), key)
    placed = placed.select(*key, F.posexplode(F.arrays_zip("uids", "before", "roles")).alias("at", "x")).select(*key, "at", "x.uids", "x.before", "x.roles")
    placed = placed.where("roles IS NOT NULL OR before <> ''")
    lines = placed.join(rows.select("uid", "role", "text").hint("merge"), placed["uids"] == rows["uid"], "left")
    own = F.when(F.col("roles") == "", F.concat("role", F.lit(":"), "text")).when(F.col("roles").isNotNull(), F.concat("roles", F.lit(":"), "text"))
    line = F.when(F.col("before") == "", own).otherwise(F.concat_ws("\n", "before", own))
    return totals, lines.select(*key, "at", line.cast("binary").alias("line")), scratch


def repaired_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", width: int = WIDTH) -> DataFrame:
    """The figures of `repair` on damaged conversations, and the hash of what they become, for every conversation there was."""
    spark = turns.sparkSession
    totals, lines, scratch = repair(damage(turns, conv, turn, role, text), width=width)
    lines = lines.repartition(parts(spark), "cid").sortWithinPartitions("cid", "part", "seg", "at")
    hashes = lines.select("cid", "line").mapInArrow(_hashes, "cid string, repaired_sha256 string")
    every = turns.select(F.col(f"`{conv}`").cast("long").alias("conv_id")).distinct().withColumn("cid", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
    found = every.join(totals.hint("merge"), "cid", "left").join(hashes.hint("merge"), "cid", "left")
    longs = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *longs, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))

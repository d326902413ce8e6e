"""Embedding near-dedup (operator 6): spherical k-means cells, blocked cosine products within cells.

Equal vectors are one node with a count. Every vector has a home, the cell of its nearest centroid, and is a guest of each
other cell whose border it lies near: two unit vectors with a cosine of at least `threshold` are at most an angle t apart,
the arc between them crosses the border of their homes, and so one of the two lies within t/2 of it. A pair is compared
where one of the two is at home, so none is missed, whatever the centroids are; they decide the work alone. Where both
meet in both homes, the smaller cell counts.

Cells that hold many vectors are cut again in the same way: the centroids of the first level come from a sample on the
driver, those of the second from a sample of each cell, in one task for each. A cell that is still large, as one of near
copies, is cut into blocks, and each pair of blocks is a task of its own. Products are in single precision, less a margin
for their rounding, and in double precision for what that leaves. Blocks hand on link counts and a star per group.

Work: vectors that lie in clusters are guests of few cells. Without clusters (unrelated vectors of 64 dimensions) they are
guests of about half of all cells, so that cells cost more than they save. All visits are counted before a row is copied,
and where comparing all vectors in blocks costs less, there is one cell. The rows are then copied once for each block; the
products grow with the square of the vectors, which no border can help where all vectors are far from each other alike.

Cases: null, zero and non-finite vectors, and empty ones, link with nothing; vectors of different lengths do not link;
equal and repeated vectors link with each other; an empty table gives an empty result; other columns are not looked at.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  for pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .components import components, local_roots

CELL = 4_096  # vectors that should have their home in a cell; a copy of a vector costs as much as some hundred products
FIRST = 256  # cells of the first level, or the square root of all cells if that is more
SECOND = 1_024  # cells of the second level in one of the first, at most; what they hold too many of goes into blocks
PER_CELL = 24  # sampled vectors for each cell
BLOCK = 32_768  # rows of a cell, guests too, that one task takes against as many others
ROW = 2_000  # products that cost as much as one more copy of a row
TILE = 512, 2_048  # rows of one product
DEALT = "rep long, times long, vec {vec}, top int, home_top int, tops array<int>"


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Unit centroids of unit rows; a cell that loses all its rows takes the row that lies worst."""
    rng = np.random.default_rng(5)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near, best = np.empty(len(x), np.int64), np.empty(len(x))
        for i in range(0, len(x), 4096):
            s = x[i : i + 4096] @ c.T
            near[i : i + 4096], best[i : i + 4096] = s.argmax(1), s.max(1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.linalg.norm(total, axis=1)
        worst = np.argsort(best)
        empty = np.flatnonzero(size == 0)
        total[empty], size[empty] = x[worst[: len(empty)]], 1
        c = total / size[:, None]
    return c


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of a list column of one length, in double precision, divided by their norms."""
    x = np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def reach(x: np.ndarray, c: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's home, and as two arrays the rows and the cells where they are at home or guests."""
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * c @ c.T)) * math.sqrt((1 - threshold) / 2) + 1e-9
    homes, rows, cells = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i in range(0, len(x), 1024):
        s = x[i : i + 1024] @ c.T
        home = s.argmax(1)
        row, cell = np.nonzero(s[np.arange(len(s)), home][:, None] - s <= apart[home])
        homes.append(home), rows.append(row + i), cells.append(cell)
    return np.concatenate(homes), np.concatenate(rows), np.concatenate(cells)


def _lists(rows: np.ndarray, values: np.ndarray, n: int, kind) -> pa.Array:
    """For each of n rows the list of its values; rows ascend."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)), pa.array(values.astype(kind)))


def _count(cells, threshold: float):
    """How many vectors each cell of the first level will have, and how many of them at home."""

    def run(batches):
        size = sum(len(c) for c, _ in cells.value.values())
        n, homes = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims):
                c, first = cells.value[dim]
                home, _, cell = reach(_unit(b.column("vec").take(pa.array(np.flatnonzero(dims == dim)))), c, threshold)
                n[first : first + len(c)] += np.bincount(cell, minlength=len(c))
                homes[first : first + len(c)] += np.bincount(home, minlength=len(c))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(n), pa.array(homes)], names=["top", "n", "homes"])

    return run


def cells_pay(n: np.ndarray, homes: np.ndarray) -> bool:
    """n, homes: the vectors that each cell will have, and those at home. Whether that costs less than one cell in blocks."""
    total = float(homes.sum())
    return float(n.astype(float) @ homes) + ROW * float(n.sum()) < total * total / 2 + ROW * total * math.ceil(total / BLOCK)


def _first(cells, threshold: float):
    def run(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims):
                own = b.take(pa.array(np.flatnonzero(dims == dim)))
                c, first = cells.value[dim]
                home, row, cell = reach(_unit(own.column("vec")), c, threshold)
                tops, at = _lists(row, cell + first, len(own), np.int32), pa.array(row)
                yield pa.RecordBatch.from_arrays([own.column("rep").take(at), own.column("times").take(at), own.column("vec").take(at), pa.array((cell + first).astype(np.int32)), pa.array((home[row] + first).astype(np.int32)), tops.take(at)], names=["rep", "times", "vec", "top", "home_top", "tops"])

    return run


def _centroids(group: pa.Table) -> pa.Table:
    """Of the sampled vectors of one cell of the first level."""
    group = group.combine_chunks().sort_by("rep")
    c = spherical_kmeans(_unit(group.column("vec").combine_chunks()), min(len(group), group.column("k")[0].as_py()))
    return pa.table({"top": group.column("top").slice(0, 1), "flat": pa.array([c.ravel().tolist()], pa.list_(pa.float64()))})


def _second(threshold: float):
    def run(rows: pa.Table, centroids: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        x = _unit(rows.column("vec").combine_chunks()) if len(rows) else np.zeros((0, 1))
        c = np.array(centroids.column("flat")[0].as_py()).reshape(-1, x.shape[1]) if len(centroids) and len(rows) else np.zeros((1, x.shape[1]))
        home, row, cell = reach(x, c, threshold)
        base, at = rows.column("top").to_numpy().astype(np.int64) * SECOND, pa.array(row)
        leaves = _lists(row, cell + base[row], len(rows), np.int64)
        more = {"leaf": pa.array(cell + base[row]), "home_leaf": pa.array((home + base)[row]), "leaves": leaves.take(at)}
        return pa.table({n: rows.column(n).take(at) for n in ("rep", "times", "vec", "top", "home_top", "tops")} | more)

    return run


def _told_elsewhere(u: np.ndarray, v: np.ndarray, here: int, home: np.ndarray, visits: pa.ChunkedArray) -> np.ndarray:
    """Of pairs that meet here: whether they also meet in a smaller cell, the home of one, where the other is a guest."""
    homes, at = np.unique(home, return_inverse=True)
    flat, sizes = visits.combine_chunks().flatten().to_numpy(), pa.compute.list_value_length(visits).to_numpy()
    place = np.minimum(np.searchsorted(homes, flat), len(homes) - 1)
    met = homes[place] == flat
    there = np.zeros((len(home), len(homes)), bool)
    there[np.repeat(np.arange(len(home)), sizes)[met], place[met]] = True
    there[:, homes >= here] = False
    return ((home[u] == here) & there[u, at[v]]) | ((home[v] == here) & there[v, at[u]])


def alike(x: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float, same: bool = False):
    """Pairs of rows, one of a and one of b, with a product of `threshold` or more, in parts; same: a is b, and each pair is
    told once. Single precision errs by less than the margin; what it does not rule out is settled in double precision."""
    low = np.float32(threshold - 2e-7 * (x.shape[1] + 8))
    fa, fb = x[a].astype(np.float32), x[b].astype(np.float32)
    for p in range(0, len(a), TILE[0]):
        for q in range(0, len(b), TILE[1]):
            u, v = a[p : p + TILE[0]], b[q : q + TILE[1]]
            if same and q + len(v) <= p:
                continue
            at = np.flatnonzero((fa[p : p + len(u)] @ fb[q : q + len(v)].T).ravel() >= low)
            if 16 * len(at) > len(u) * len(v):
                at = np.flatnonzero((x[u] @ x[v].T).ravel() >= threshold)
            else:
                at = np.concatenate([at[:0], *(s[np.einsum("ij,ij->i", x[u[s // len(v)]], x[v[s % len(v)]]) >= threshold] for s in (at[i : i + 4_096] for i in range(0, len(at), 4_096)))])
            r, c = np.divmod(at, len(v))
            if same:
                r, c = r[p + r < q + c], c[p + r < q + c]
            if len(r):
                yield u[r], v[c]


def _compare(threshold: float):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        leaf, i, j = (x.as_py() for x in key)
        group = group.combine_chunks().sort_by("rep")
        top = group.column("top")[0].as_py()
        x = _unit(group.column("vec").combine_chunks())
        rep, times, block, home_top, home_leaf = (group.column(n).to_numpy() for n in ("rep", "times", "block", "home_top", "home_leaf"))
        n, in_top, in_leaf = len(rep), home_top == top, home_leaf == leaf
        links, us, vs, held, root = np.zeros(n, np.int64), [], [], 0, np.arange(n)

        def kind(which: int, t: bool, l: bool) -> np.ndarray:
            return np.flatnonzero((block == which) & (in_top == t) & (in_leaf == l))

        def meet(a: np.ndarray, b: np.ndarray, same: bool = False) -> None:
            nonlocal links, held, root
            for u, v in alike(x, a, b, threshold, same):
                new = ~_told_elsewhere(u, v, top, home_top, group.column("tops")) & ~_told_elsewhere(u, v, leaf, home_leaf, group.column("leaves"))
                u, v = u[new], v[new]
                links += np.bincount(u, times[v], n).astype(np.int64) + np.bincount(v, times[u], n).astype(np.int64)
                us.append(u), vs.append(v)
                held += len(u)
                if held > 2_000_000:  # a dense cell: keep what the pairs join, not the pairs
                    root, held = local_roots(n, np.concatenate([np.arange(n), *us]), np.concatenate([root, *vs])), 0
                    us.clear(), vs.clear()

        both, of_top, of_leaf, guests = ([kind(w, t, l) for w in (i, j)] for t, l in ((True, True), (True, False), (False, True), (False, False)))
        meet(both[0], both[1], i == j)
        meet(both[0], np.concatenate([of_top[1], of_leaf[1], guests[1]]))
        meet(of_top[0], of_leaf[1])
        if i != j:
            meet(np.concatenate([of_top[0], of_leaf[0], guests[0]]), both[1])
            meet(of_leaf[0], of_top[1])
        root = local_roots(n, np.concatenate([np.arange(n), *us]), np.concatenate([root, *vs]))
        told = links > 0
        return pa.table({"rep": rep[told], "links": links[told], "root": rep[root[told]]})

    return run


def _cut_again(dealt: DataFrame, sizes: DataFrame, scratch: Scratch, threshold: float, kind: str) -> DataFrame:
    """Rows of cells that hold too many, in cells of the second level, with the number of blocks of each."""
    cut = scratch.table(dealt.join(F.broadcast(sizes.withColumnRenamed("blocks", "salts")), "top"), "cut")
    sampled = F.pmod(F.xxhash64("rep", F.lit(9)), F.lit(1 << 30)) < math.ceil(min(1.0, 1.1 * PER_CELL / CELL) * (1 << 30))
    some = cut.where((F.col("top") == F.col("home_top")) & sampled).select("top", "rep", "vec", "k")
    centroids = scratch.table(some.groupBy("top").applyInArrow(_centroids, "top int, flat array<double>"), "centroids")
    many = centroids.join(F.broadcast(sizes), "top").select("top", "flat", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("salt"))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("salts")).cast("int")).drop("k", "salts")
    wide = DEALT.format(vec=kind) + ", leaf long, home_leaf long, leaves array<long>"
    under = scratch.table(salted.groupBy("top", "salt").cogroup(many.groupBy("top", "salt")).applyInArrow(_second(threshold), wide), "under")
    blocks = scratch.table(under.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "blocks")
    return under.join(scratch.shuffled(blocks.where("blocks > 1")), "leaf", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))


def embedding_dedup(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embeddings")
    vec = F.col(f"`{vec_col}`")  # moved as it is stored, made double in the tasks
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vec.alias("vec"))
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) | ~F.exists("vec", lambda v: v != 0)
    rows = scratch.table(rows.withColumn("ok", F.col("vec_id").isNotNull() & F.coalesce(~bad, F.lit(False))), "rows")
    good = rows.where("ok").select("vec_id", "vec")
    nodes = scratch.table(good.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("times")).withColumn("dim", F.size("vec")), "nodes")
    cells, first = {}, 0
    for dim, n in sorted(nodes.groupBy("dim").count().collect()):  # one row per vector length
        k = math.ceil(n / CELL)
        k = min(k, max(FIRST, math.isqrt(k)))
        some = nodes.where((F.col("dim") == dim) & (F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < math.ceil(min(1.0, 1.1 * PER_CELL * k / n) * (1 << 30)))).select("rep", "vec").toArrow().sort_by("rep")
        c = spherical_kmeans(_unit(some.column("vec").combine_chunks()), min(k, len(some))) if len(some) else np.eye(1, dim)
        cells[dim], first = (c, first), first + len(c)
    shared = spark.sparkContext.broadcast(cells)  # FIRST or the square root of n / CELL centroids for each length
    kind = nodes.schema["vec"].dataType.simpleString()
    told = nodes.select("vec", "dim").mapInArrow(_count(shared, threshold), "top int, n long, homes long").groupBy("top").agg(F.sum("n").alias("n"), F.sum("homes").alias("homes"))
    told = told.orderBy("top").toArrow()  # a row for each cell
    n, homes, first, kept = told.column("n").to_numpy(), told.column("homes").to_numpy(), 0, []
    for dim, (c, at) in cells.items():
        own = slice(at, at + len(c))
        pay = len(c) > 1 and cells_pay(n[own], homes[own])
        kept += list(zip(n[own].tolist(), homes[own].tolist(), [SECOND] * len(c), strict=True)) if pay else [(int(homes[own].sum()), int(homes[own].sum()), 1)]
        cells[dim], first = (c if pay else c[:1], first), first + (len(c) if pay else 1)
    shared = spark.sparkContext.broadcast(cells)
    dealt = nodes.mapInArrow(_first(shared, threshold), DEALT.format(vec=kind))
    sizes = spark.createDataFrame([(i, *x) for i, x in enumerate(kept)], "top int, n long, homes long, most int")
    cut_up = F.least("most", F.ceil(F.col("homes") / CELL)).cast("int")
    sizes = scratch.table(sizes.select("top", cut_up.alias("k"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "sizes")  # a row for each cell
    leaf = F.col("top").cast("long") * SECOND
    whole = dealt.join(F.broadcast(sizes.where("k <= 1").drop("k")), "top").select(*dealt.columns, leaf.alias("leaf"), leaf.alias("home_leaf"), F.array(leaf).alias("leaves"), "blocks")
    many = whole.unionByName(_cut_again(dealt, sizes.where("k > 1"), scratch, threshold, kind)) if sizes.where("k > 1").count() else whole
    many = many.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    tasks = many.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    tasks = tasks.select("leaf", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "times", "vec", "top", "home_top", "tops", "home_leaf", "leaves")
    found = scratch.table(tasks.groupBy("leaf", "i", "j").applyInArrow(_compare(threshold), "rep long, links long, root long"), "found")
    roots = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")), scratch)
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = nodes.join(scratch.shuffled(links), "rep", "left").join(scratch.shuffled(roots).withColumnRenamed("node", "rep"), "rep", "left")
    known = scratch.table(known.select("vec", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id")), "known")
    linked = good.join(scratch.shuffled(known), "vec").select("vec_id", "n_links", "component_id")
    apart = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(apart).select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))

"""Near-duplicate vectors by blocks of neighbours and exact distance bounds (operator 9).

Equal vectors are one class. k-means centres are fitted on a bounded sample; each
class goes to the cell of its nearest centre, and the cells are stored once, in
groups of a bounded size. Every pair of groups is compared by one task that reads
both groups from that table: no vector is shuffled or written for each cell it may
have links in. Inside a pair of groups two bounds leave out what cannot link; for
linked vectors |x - y| <= sqrt(2 - 2 threshold):

- between two blocks (runs of a cell), along the line through their means:
  |x - y| is at least the distance of the projections;
- between two vectors, in the sample's first principal directions, by products in
  single precision with room for their rounding.

Both hold for any partition and any directions, which only decide how much is left
out, so every link is found. What passes is compared in double precision; a link
counts for both vectors, once. Pairs of groups return counts of links and a
spanning forest instead of pairs; components are then merged over all groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from upswing.llm.common import connected_components, map_arrow, store, two_hashes, unit_hash

SAMPLE = 20_000  # vectors the centres are fitted on (expected)
CELL = 1_250  # aimed vectors of a cell
MOST_CELLS = SAMPLE // 4  # a larger cell is several blocks
SLACK = 1e-6  # added to the margin, for rounding
BLOCK = 2_048  # vectors of a cell compared at once
GROUP = 24_576  # aimed vectors of a group, at most
GROUP_BYTES = 6 << 20  # aimed bytes of their components, at most
LEAST_GROUPS = 12  # aimed at, so that there are pairs for many tasks
SIDE = 64  # partitions that the groups are read in, on each side of a pair
SIDE_BYTES = 64 << 20  # that a partition of the second side holds in memory
STRIP = 96  # vectors of a block compared at once with those their bound leaves
PASS = 2e-5  # share of pairs that the principal directions may leave, before some more are taken


@contextmanager
def _set(spark: SparkSession, key: str, value: str):
    """``key`` set to ``value`` for what is run inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """``k`` unit centres (fewer if there are fewer vectors) of the unit rows of ``x``."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        home = np.concatenate([(x[a : a + 4096] @ centres.T).argmax(axis=1) for a in range(0, len(x), 4096)])
        order = np.argsort(home, kind="stable")
        used, first = np.unique(home[order], return_index=True)
        sums = np.add.reduceat(x[order], first, axis=0)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = centres.copy()
        centres[used] = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centres[used])
    return centres


def principal_directions(x: np.ndarray, reach: float) -> np.ndarray:
    """The fewest first principal directions (columns) in which few pairs of ``x`` farther apart than ``reach`` come as near as it."""
    dim = x.shape[1]
    basis = np.linalg.eigh(np.cov(x.T).reshape(dim, dim))[1][:, ::-1]
    a, b = x[::2][:300] @ basis, x[1::2][:300] @ basis
    near = None
    for q in range(dim, 0, -2):
        square = (a[:, None, :q] ** 2).sum(axis=2) + (b[None, :, :q] ** 2).sum(axis=2) - 2 * a[:, :q] @ b[:, :q].T
        passed = square <= reach * reach
        if near is None:
            near = passed
        elif (passed & ~near).mean() > PASS:
            return basis[:, : min(q + 6, dim)]
    return basis[:, : min(q + 4, dim)]


def _unit(packed: np.ndarray) -> np.ndarray:
    x = packed.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _rows(column: pa.Array, kind: str, dim: int) -> np.ndarray:
    """The vectors of ``dim`` components that a binary array without nulls holds."""
    at = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].view(kind).reshape(-1, dim)


def _binary(x: np.ndarray) -> pa.Array:
    """Each row of ``x`` as one binary value."""
    x = np.ascontiguousarray(x)
    at = np.arange(len(x) + 1, dtype=np.int64) * (x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(x)])


def _pack(kind: str):
    """The vectors that can link with any: of finite components, some of them not zero, and with a norm. -0.0 is 0.0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                lists = batch.column("embedding")
                values = lists.flatten()
                values = (values.fill_null(math.nan) if values.null_count else values).to_numpy(zero_copy_only=False).astype(kind, copy=False)
                size = lists.value_lengths().to_numpy(zero_copy_only=False)
                first = np.cumsum(size) - size
                for dim in np.unique(size[size > 0]):
                    rows = np.flatnonzero(size == dim)
                    x = values[first[rows][:, None] + np.arange(dim)] + np.zeros(1, kind)
                    with np.errstate(over="ignore", invalid="ignore"):
                        norm = (x.astype(np.float64) ** 2).sum(axis=1)
                    good = np.isfinite(x).all(axis=1) & (norm > 0) & np.isfinite(norm)
                    ids = batch.column("vec_id").take(pa.array(rows[good]))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(np.full(len(ids), dim, np.int32)), _binary(x[good])], names=["vec_id", "dim", "embedding"])

    return run


def _assign(kind: str, centres: dict[int, np.ndarray]):
    """The cell of each class: that of the nearest centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                dims = batch.column("dim").to_numpy()
                cell = np.zeros(len(dims), np.int32)
                for d in np.unique(dims):
                    if d in centres:  # a length the sample does not have is one cell
                        rows = np.flatnonzero(dims == d)
                        x = _unit(_rows(batch.column("embedding").take(pa.array(rows)), kind, int(d)))
                        cell[rows] = (x.astype(np.float32) @ centres[d].T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    return run


def _gather(group: int, group_bytes: int, itemsize: int):
    """Rows in order of dim and cell, as groups: one row each, of one dim."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, dim = [], 0, 0

        def out() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            data = t.column("embedding").chunk(0)
            at = np.frombuffer(data.buffers()[1], np.int32, len(data) + 1, 4 * data.offset)
            plain = [memoryview(data.buffers()[2])[at[0] : at[-1]], *(np.ascontiguousarray(t.column(c).to_numpy()).data.cast("B") for c in ("rep", "copies", "cell"))]
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *(pa.array([p], pa.binary()) for p in plain)], names=["dim", "embedding", "rep", "copies", "cell"])

        for whole in batches:
            dims = whole.column("dim").to_numpy()
            at = 0
            while at < len(dims):
                if held and (dims[at] != dim or n >= most):
                    yield out()
                    held, n = [], 0
                dim = int(dims[at])
                most = max(1, min(group, group_bytes // (itemsize * dim)))
                end = min(int(np.searchsorted(dims, dim, side="right")), at + most - n)
                held.append(whole.slice(at, end - at))
                n, at = n + end - at, end
        if held:
            yield out()

    return run


class _Group:
    """The vectors of a group, its blocks and their means, and the vectors' principal components as factors of a product that bounds the distance."""

    def __init__(self, dim: int, embedding, rep, copies, cell, kind: str, basis: np.ndarray | None, cell_size: int, block: int):
        self.packed = np.frombuffer(embedding, kind).reshape(-1, dim)
        self.rep, self.copies, cell = np.frombuffer(rep, np.int64), np.frombuffer(copies, np.int64), np.frombuffer(cell, np.int32)
        n = len(self.rep)
        self.unit = np.empty((n, dim), np.float32)
        for a in range(0, n, 4096):
            self.unit[a : a + 4096] = _unit(self.packed[a : a + 4096])
        z = self.unit if basis is None else self.unit @ basis
        half, ones = (z * z).sum(axis=1, keepdims=True) / 2, np.ones((n, 1), np.float32)
        self.left, self.right = np.hstack([z, -half, ones]), np.hstack([z, ones, -half])
        ends, last = [], 0
        for end in [*(np.flatnonzero(np.diff(cell)) + 1), n]:  # small cells share a block
            while end - last > block:
                last += block
                ends.append(last)
            if end == n or end - last >= min(block, cell_size) // 2:
                last = end
                ends.append(end)
        self.blocks = [(a, b) for a, b in zip([0, *ends[:-1]], ends, strict=True) if b > a]
        self.means = np.stack([self.unit[a:b].mean(axis=0) for a, b in self.blocks])
        self.own = np.concatenate([self.unit[a:b] @ m for (a, b), m in zip(self.blocks, self.means, strict=True)])


class _Forest:
    """Components of the rows met by links so far: ``root`` is the smallest row of each."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while ((up := self.root[self.root]) != self.root).any():
                self.root = up


def _links(left: _Group, right: _Group, threshold: float, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between two groups, or inside one: their number for each vector of the left and of the right, and each vector's root."""
    same = left is right
    shift = 0 if same else len(left.rep)
    count, forest = [np.zeros(len(g.rep), np.int64) for g in (left, right)], _Forest(shift + len(right.rep))
    room = 1e-5 + 1.2e-7 * left.unit.shape[1]  # what rounding may do to a product in single precision
    least = np.float32(threshold - 1 - room - 2.5e-7 * left.left.shape[1])
    maybe, held = [], 0
    room_for = np.empty(STRIP * max(d - c for c, d in right.blocks), np.float32)

    def linked(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs are linked, in double precision."""
        near = left.rep[i] != right.rep[j]
        for a in range(0, len(i), 4096):
            near[a : a + 4096] &= np.einsum("ij,ij->i", _unit(left.packed[i[a : a + 4096]]), _unit(right.packed[j[a : a + 4096]])) >= threshold
        return near

    def check() -> None:
        """Count what is linked of the pairs that the bounds left."""
        nonlocal held
        if not maybe:
            return
        i, j = (np.concatenate(ends) for ends in zip(*maybe, strict=True))
        maybe.clear()
        held = 0
        near = linked(i, j)
        i, j = i[near], j[near]
        np.add.at(count[0], i, right.copies[j])
        np.add.at(count[1], j, left.copies[i])
        forest.link(i, j + shift)

    def strip(i: np.ndarray, j: np.ndarray, some: np.ndarray, factors: np.ndarray, inside: bool) -> None:
        """Links of some vectors of the left with some of the right; ``inside`` a block, with those that come later."""
        nonlocal held
        bound = np.matmul(some, factors.T, out=room_for[: len(i) * len(j)].reshape(len(i), len(j)))
        if bound.max() < least:
            return
        at = np.flatnonzero(bound.ravel() >= least)
        if 8 * len(at) < bound.size:
            a, b = i[at // len(j)], j[at % len(j)]
            if inside:
                later = a < b
                a, b = a[later], b[later]
            maybe.append((a, b))
            held += len(a)
            if held > 100_000:
                check()
            return
        dot = left.unit[i] @ right.unit[j].T  # many links: without a list of them
        apart = left.rep[i][:, None] != right.rep[j][None, :]
        if inside:
            apart &= i[:, None] < j[None, :]
        near = apart & (dot >= threshold)
        a, b = np.nonzero(apart & (np.abs(dot - threshold) <= room))
        near[a, b] = linked(i[a], j[b])
        count[0][i] += near @ right.copies[j]
        count[1][j] += left.copies[i] @ near
        while (apart := near & (forest.root[i][:, None] != forest.root[j + shift][None, :])).any():
            rows = np.flatnonzero(apart.any(axis=1))
            forest.link(i[rows], j[apart[rows].argmax(axis=1)] + shift)

    to_left, to_right = right.unit @ left.means.T, left.unit @ right.means.T
    for k, (a, b) in enumerate(left.blocks):
        for m, (c, d) in enumerate(right.blocks):
            if same and m < k:
                continue
            gap = float(np.linalg.norm(left.means[k] - right.means[m]))
            inside = same and m == k
            if inside or gap < 1e-3:
                i, j = np.arange(a, b), np.arange(c, d)
                for at in range(0, len(i), STRIP):
                    after = at if inside else 0
                    strip(i[at : at + STRIP], j[after:], left.left[a + at : min(a + at + STRIP, b)], right.right[c + after : d], inside)
                continue
            x, y = (left.own[a:b] - to_right[a:b, m]) / gap, (to_left[c:d, k] - right.own[c:d]) / gap
            most = reach + room * (1 + 4 / gap)
            i, j = np.flatnonzero(x <= y.max() + most), np.flatnonzero(y >= x.min() - most)
            if not (len(i) and len(j)):
                continue
            i, j = i[np.argsort(x[i])], j[np.argsort(-y[j])]
            n_near = np.searchsorted(-y[j], most - x[i[::STRIP]], side="right")
            i, j = i + a, j + c
            some, factors = left.left[i], right.right[j]
            for at, n in zip(range(0, len(i), STRIP), n_near.tolist(), strict=True):
                if not n:
                    break
                strip(i[at : at + STRIP], j[:n], some[at : at + STRIP], factors[:n], False)
    check()
    return count[0], count[1], forest.root


def _compare(threshold: float, reach: float, kind: str, bases: dict[int, np.ndarray], cell_size: int, block: int):
    """A pair of groups (columns of the second end in 2): link counts, and links that join components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, _Group] = {}

        def group(row: dict, end: str) -> _Group:
            return kept.get(row["gid" + end]) or _Group(row["dim" + end], *(row[c + end].as_buffer() for c in ("embedding", "rep", "copies", "cell")), kind, bases.get(row["dim" + end]), cell_size, block)

        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: v[at] if pa.types.is_binary(v.type) else v[at].as_py() for c, v in zip(batch.schema.names, batch.columns, strict=True)}
                left = group(row, "")
                kept = {row["gid"]: left}
                kept[row["gid2"]] = right = group(row, "2")
                n_left, n_right, root = _links(left, right, threshold, reach)
                rep = left.rep if left is right else np.concatenate([left.rep, right.rep])
                n = n_left + n_right if left is right else np.concatenate([n_left, n_right])
                some, joined = np.flatnonzero(n), np.flatnonzero(root != np.arange(len(root)))
                none = [pa.nulls(len(joined), pa.int64()), pa.nulls(len(some), pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.array(rep[some]), none[0]]),
                        pa.concat_arrays([pa.array(n[some]), none[0]]),
                        pa.concat_arrays([none[1], pa.array(rep[root[joined]])]),
                        pa.concat_arrays([none[1], pa.array(rep[joined])]),
                    ],
                    names=["rep", "links", "a", "b"],
                )

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.9, margin: float | None = None) -> DataFrame:
    """Links of cosine >= ``threshold`` among ``vectors`` (vec_id, embedding), and their components.

    Returns one row per input row: vec_id, n_links (other vectors linked
    directly), component_id (smallest vec_id reachable), kept. Vectors that are
    null, empty, zero or hold null or non-finite components link with nothing,
    as do vectors of different lengths. Equal rows are one vector; a null vec_id
    links with nothing, its component is null and it is kept. Links below the
    threshold are never reported, and all others are found; a ``margin`` (half a
    distance of unit vectors) below the default, that of the threshold, loses
    some. Other columns are not read.
    """
    spark = vectors.sparkSession
    if margin is None:
        margin = math.sqrt(max(0.0, (1 - threshold) / 2)) + SLACK
    single = isinstance(vectors.schema["embedding"].dataType.elementType, FloatType)
    kind, itemsize = ("<f4", 4) if single else ("<f8", 8)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{'float' if single else 'double'}>").alias("embedding"))
    packed = map_arrow(rows.where("vec_id is not null and size(embedding) > 0"), _pack(kind), "vec_id long, dim int, embedding binary")
    p, q = two_hashes("embedding")
    prints = packed.select("vec_id", p.alias("p"), q.alias("q"), "dim", "embedding")
    ids = prints.select("vec_id", "p", "q").distinct()
    classes = ids.groupBy("p", "q").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    members = store(ids.join(classes, ["p", "q"]), "vectors")
    ranked = members.where("vec_id = rep").select("p", "q", "rep", "copies")
    # one vector of a class leaves each partition that has some; the rest of their rows is narrow
    reps = store(prints.groupBy("p", "q").agg(F.first("dim").alias("dim"), F.first("embedding").alias("embedding")).join(ranked, ["p", "q"]).select("rep", "copies", "dim", "embedding"), "reps")
    n = reps.count()
    sample = reps.where(unit_hash("rep") * n < SAMPLE).select("dim", "embedding").toPandas()
    centres, bases, size = {}, {}, 0.0
    for dim, group in sample.groupby("dim"):
        x = _unit(np.frombuffer(b"".join(group["embedding"]), kind).reshape(-1, dim))
        x = x[np.lexsort(x.T[::-1])]
        here = n * len(x) / len(sample)
        size += here * dim * itemsize
        centres[int(dim)] = spherical_kmeans(x, max(1, min(MOST_CELLS, math.ceil(here / CELL)))).astype(np.float32)
        if len(x) > 1:
            x = x[np.random.default_rng(3).permutation(len(x))]
            bases[int(dim)] = principal_directions(x, 2 * margin).astype(np.float32)

    n_groups = max(math.ceil(n / GROUP), math.ceil(size / GROUP_BYTES), min(LEAST_GROUPS, math.ceil(n / BLOCK)), 1)
    placed = map_arrow(reps, _assign(kind, centres), "rep long, copies long, dim int, embedding binary, cell int")
    placed = placed.repartition(n_groups, "dim", "cell").coalesce(n_groups).sortWithinPartitions("dim", "cell")
    # cells are dealt unevenly: a group may hold twice its share
    groups = map_arrow(placed, _gather(2 * GROUP, 2 * GROUP_BYTES, itemsize), "dim int, embedding binary, rep binary, copies binary, cell binary")
    with _set(spark, "spark.sql.files.maxRecordsPerFile", "1"):
        groups = store(groups.withColumn("gid", F.monotonically_increasing_id()), "groups").coalesce(max(min(SIDE, max(LEAST_GROUPS, math.ceil(n_groups / 3))), math.ceil(size / SIDE_BYTES)))
    other = groups.withColumnsRenamed({c: f"{c}2" for c in groups.columns})
    odd = F.xxhash64("gid").bitwiseXOR(F.xxhash64("gid2")).bitwiseAND(F.lit(1).cast("long")) == 1
    once = (F.col("gid") == F.col("gid2")) | (odd & (F.col("gid") < F.col("gid2"))) | (~odd & (F.col("gid") > F.col("gid2")))
    pairs = groups.hint("shuffle_replicate_nl").join(other, (F.col("dim") - F.col("dim2") == 0) & once)
    with _set(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "1"):
        found = store(map_arrow(pairs, _compare(threshold, 2 * margin, kind, bases, CELL, BLOCK), "rep long, links long, a long, b long"), "links")
    links = found.where("rep is not null").groupBy("rep").agg(F.sum("links").alias("links"))
    same = members.where("vec_id <> rep").select(F.col("rep").alias("a"), F.col("vec_id").alias("b"))
    components = connected_components(found.where("a is not null").select("a", "b").unionAll(same), "vectors")
    alone = F.coalesce("links", F.lit(0).cast("long"))
    counted = members.join(links, "rep", "left").groupBy("vec_id").agg(F.max(alone + F.col("copies") - 1).alias("n_links"))
    return (
        rows.select("vec_id")
        .join(counted, "vec_id", "left")
        .join(components.withColumnsRenamed({"node": "vec_id", "component": "component_id"}), "vec_id", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )

"""Near-duplicate documents by circulant MinHash (operator 2).

Every distinct set of word shingles is hashed into ``DOMAIN`` places by a first
permutation (a 64-bit mixer); a second permutation of the places, circularly
shifted by k, gives signature coordinate k. One table of the second permutation
therefore yields all coordinates: those of a shingle at place p are the
``COORDS`` consecutive entries that start at p. Coordinates are banded; sets
that share a band are candidates; links are confirmed by exact Jaccard
similarity on the full sets.

Links are found without listing all pairs of a bucket. Each member is first
compared with its bucket's smallest member; confirmed links are merged into
components. Only buckets that still hold several components are compared
further, members of different components only, in blocks inside the tasks, which
return at most a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswing.llm.common import BYTES_TOGETHER, ROWS_TOGETHER, Vocabulary, binary_texts, connected_components, map_arrow, mix64, store, together

DOMAIN = 1 << 21  # places of the second permutation
BANDS, ROWS = 32, 4
COORDS = BANDS * ROWS
BLOCK = 200  # members of a bucket compared at once
CELLS = 4 << 20  # of the table of sets and shingles that is multiplied at once
TOGETHER = 64  # texts whose words are hashed at once
SEED = 20_240_601


def shingle_sets(texts: Iterator[bytes | None], words_per: int, vocab: Vocabulary) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text.

    A-Z are lower-cased, words are runs of other than ASCII white space; a text
    of fewer than ``words_per`` words is one shingle, one without words has none.
    """
    factors = mix64(np.arange(1, words_per + 1, dtype=np.uint64)) | np.uint64(1)
    texts = iter(texts)
    while some := list(islice(texts, TOGETHER)):
        words = [text.lower().split() if text else [] for text in some]
        h, at = vocab.hashes(list(chain.from_iterable(words))), 0
        n = max(0, len(h) - words_per + 1)
        total = np.full(n, np.uint64(words_per))  # at every place, also where a text ends
        for i in range(words_per):
            total += mix64(h[i : i + n] * factors[i])
        total = mix64(total)
        for size in map(len, words):
            if size >= words_per:
                yield np.unique(total[at : at + size - words_per + 1])
            elif size:
                one = mix64(h[at : at + size] * factors[:size]).sum(keepdims=True, dtype=np.uint64)
                yield mix64(one + np.uint64(size))
            else:
                yield np.empty(0, dtype=np.uint64)
            at += size


_TABLE: np.ndarray | None = None


def _second_permutation() -> np.ndarray:
    """The second permutation, extended so that a circular window is a slice."""
    global _TABLE
    if _TABLE is None:
        p = np.random.Generator(np.random.PCG64(SEED)).permutation(DOMAIN).astype(np.int32)
        _TABLE = np.concatenate([p, p[:COORDS]])
    return _TABLE


def signature(shingles: np.ndarray) -> np.ndarray:
    """The ``COORDS`` circulant MinHash coordinates of a non-empty set."""
    windows = np.lib.stride_tricks.sliding_window_view(_second_permutation(), COORDS)
    places = (mix64(shingles ^ np.uint64(SEED)) & np.uint64(DOMAIN - 1)).astype(np.int64)
    out = np.full(COORDS, DOMAIN, dtype=np.int32)
    for at in range(0, len(places), 2048):
        np.minimum(out, windows[places[at : at + 2048]].min(axis=0), out=out)
    return out


def band_keys(coords: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, different between bands."""
    rows = coords.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return key.view(np.int64)


def _sign(words_per: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabulary()
        for batch in batches:
            n, fp, fp2, bands = [], [], [], []
            for s in shingle_sets(binary_texts(batch.column("text")), words_per, vocab):
                n.append(len(s))
                digest = xxhash.xxh3_128_digest(s.tobytes())
                fp.append(int.from_bytes(digest[:8], "little", signed=True))
                fp2.append(int.from_bytes(digest[8:], "little", signed=True))
                bands.append(band_keys(signature(s)) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.binary_length(batch.column("text")).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(fp, pa.int64()), pa.array(fp2, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_bytes", "n_shingles", "fp", "fp2", "bands"],
            )

    return run


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a & b| >= percent * |a | b| for sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int(np.count_nonzero(b[at] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify(words_per: int, percent: int):
    """Rows sorted by (leader, chunk, member): compare each member with the leader before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, key, lead = Vocabulary(), None, []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("leader", "chunk", "is_member", "id")]
            a, b = [], []
            for leader, chunk, member, ident, s in zip(*cols, shingle_sets(binary_texts(batch.column("text")), words_per, vocab), strict=True):
                if (leader, chunk) != key:
                    key, lead = (leader, chunk), []
                if not member:
                    lead.append(s)
                elif any(similar(x, s, percent) for x in lead):
                    a.append(leader)
                    b.append(ident)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def common_counts(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """The sizes of the intersections of each set of ``left`` with each of ``right``, or of ``left`` (off the diagonal)."""
    sets = left + (right or [])
    shingles, at = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = np.bincount(at, minlength=len(shingles)) > 1  # the others are in no intersection
    number = np.cumsum(shared) - 1
    row, at = row[shared[at]], number[at[shared[at]]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    others = slice(len(left), None) if right else slice(None)
    total, n, step = np.zeros((len(left), len(right or left))), int(shared.sum()), max(1, CELLS // len(sets))
    for first in range(0, n, step):
        a, b = np.searchsorted(at, [first, first + step])
        held = np.zeros((len(sets), min(step, n - first)), dtype=np.float32)  # sums of a slice are exact in it
        held[row[a:b], at[a:b] - first] = 1
        total += held[: len(left)] @ held[others].T
    return total.astype(np.int64)


def _forest(words_per: int, percent: int):
    """Rows sorted by (bucket, block pair): links between components of a group, as a spanning forest of components."""

    def links(group: list[tuple[int, int, np.ndarray]], sides: bool) -> Iterator[tuple[int, int]]:
        root = {c: c for c, _, _ in group}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        left = [r for r in group if len(r[2]) and not (sides and r[1])]
        right = [r for r in group if len(r[2]) and r[1]] if sides else left
        if not left or not right:
            return
        both = common_counts([s for *_, s in left], [s for *_, s in right] if sides else None)
        sizes = np.add.outer([len(s) for *_, s in left], [len(s) for *_, s in right])
        for i, j in np.argwhere(100 * both >= percent * (sizes - both)).tolist():
            x, y = left[i][0], right[j][0]
            if find(x) != find(y):
                root[find(x)] = find(y)
                yield x, y

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, key, group = Vocabulary(), None, []

        def out():
            found = list(links(group, key[1] != key[2]))
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("key", "i", "j", "side", "component")]
            for k, i, j, side, comp, s in zip(*cols, shingle_sets(binary_texts(batch.column("text")), words_per, vocab), strict=True):
                if (k, i, j) != key:
                    if group:
                        yield out()
                    key, group = (k, i, j), []
                group.append((comp, side, s))
        if group:
            yield out()

    return run


def block_pairs(labelled: DataFrame) -> DataFrame:
    """The members of open buckets, dealt to pairs of blocks: key, rep, component, side, i, j.

    ``labelled`` has key, rep and component. An open bucket holds several
    components; its largest one is merged already, so its members (the mains) are
    not compared with each other, only with the members of other components (the
    guests). Both are cut into blocks of about ``BLOCK``. A group (key, i, j) is
    main block i (side 0) and guest block -1 - j (side 1) if j is negative, else
    guest blocks i and j (sides 0 and 1, or one side if they are the same).
    """
    labelled = labelled.select("key", "rep", "component").repartition("key")  # dealt once, for the sums and the join
    sizes = labelled.groupBy("key", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("mains"), F.sum("n").alias("all"))
    largest = largest.where("mains < all")
    up = lambda n: F.ceil(n / F.lit(BLOCK))
    blocks = labelled.join(largest, "key").select(
        "key", "rep", "component", (F.col("component") == F.col("main")).alias("is_main"), up(F.col("mains")).alias("m"), up(F.col("all") - F.col("mains")).alias("g")
    )
    own = lambda n: F.pmod(F.xxhash64("rep"), F.col(n))
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    group = lambda side, i, j: F.struct(side.alias("side"), i.alias("i"), j.alias("j"))
    first, second = F.lit(0), F.lit(1)
    mains = F.transform(every("g"), lambda other: group(first, own("m"), F.lit(-1) - other))
    visits = F.transform(every("m"), lambda i: group(second, i, F.lit(-1) - own("g")))
    guests = F.transform(every("g"), lambda other: group((own("g") > other).cast("int"), F.least(own("g"), other), F.greatest(own("g"), other)))
    groups = F.when(F.col("is_main"), mains).otherwise(F.concat(visits, guests))
    return blocks.select("key", "rep", "component", F.explode(groups).alias("group")).select("key", "rep", "component", "group.side", "group.i", "group.j")


def _with_text(rows: DataFrame, texts: DataFrame, on: str) -> DataFrame:
    return rows.join(texts.withColumnRenamed("id", on), on)


def near_duplicates(docs: DataFrame, words_per: int = 5, percent: int = 80) -> DataFrame:
    """Near-duplicate components of ``docs`` (doc_id, text).

    Returns one row per input row: doc_id, n_shingles, component_id, kept.
    Rows without words (null or empty text) have no shingles, are linked with
    nothing and are kept. Rows that repeat a doc_id are one node of the graph. A
    null doc_id is linked with nothing: component_id is null and the row is kept.
    Copies (equal sets) are one class before banding, so groups of copies of any
    size cost one signature row. Other columns of ``docs`` are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = store(map_arrow(docs, _sign(words_per), "doc_id long, n_bytes long, n_shingles long, fp long, fp2 long, bands array<long>"), "signed")
    n, size = signed.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    text = size / max(1, n)  # bytes on average
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    # a class is all documents with one set, and its first document stands for it; equal sets have equal bands
    several = usable.groupBy("fp", "fp2").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("last")).where("a < last")
    copies = usable.select("fp", "fp2", F.col("doc_id").alias("b")).join(several, ["fp", "fp2"])
    copies = store(together(copies.where("a <> b").select("a", "b").distinct(), n, ROWS_TOGETHER), "copies")
    classes = usable.groupBy("fp", "fp2").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    banded = classes.select("rep", F.explode("bands").alias("key")).repartition("key")  # dealt once, for the sums and the join
    buckets = banded.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader < last")
    members = together(banded.join(buckets.drop("last"), "key").distinct(), BANDS * n, ROWS_TOGETHER)
    members = store(members, "members")  # only buckets with several members

    ids = members.select(F.col("rep").alias("id")).distinct()
    texts = store(together(ids.join(docs.withColumnRenamed("doc_id", "id"), "id").distinct(), size, BYTES_TOGETHER), "texts")

    pairs = members.where("rep <> leader").select("leader", "rep").distinct()
    chunks = pairs.groupBy("leader").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("chunks"))
    pairs = pairs.join(chunks, "leader").select("leader", F.expr("pmod(xxhash64(rep), chunks)").alias("chunk"), "rep")
    pairs = store(together(pairs, members.count(), ROWS_TOGETHER), "pairs")
    rows = pairs.select("leader", "chunk", F.lit(True).alias("is_member"), F.col("rep").alias("id")).unionAll(
        pairs.select("leader", "chunk", F.lit(False).alias("is_member"), F.col("leader").alias("id")).distinct()
    )
    rows = _with_text(rows, texts, "id").repartition("leader", "chunk").sortWithinPartitions("leader", "chunk", "is_member")
    rows = together(rows, 2 * pairs.count() * text, BYTES_TOGETHER)
    stars = store(map_arrow(rows, _verify(words_per, percent), "a long, b long"), "stars")
    found = connected_components(copies.unionAll(stars), "round1")

    labelled = members.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component"))
    paired = store(block_pairs(labelled), "paired")
    paired_rows = paired.count()
    # buckets with the same members (several bands of one family) are compared once
    same = paired.groupBy("key", "i", "j").agg(F.sum(F.xxhash64("rep", "side").cast("decimal(38,0)")).alias("who"), F.count("*").alias("size"))
    once = same.groupBy("who", "size", "i", "j").agg(F.min("key").alias("key")).select("key", "i", "j")
    paired = _with_text(paired.join(once, ["key", "i", "j"]), texts, "rep")
    rows = paired.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    rows = together(rows, paired_rows * text, BYTES_TOGETHER)
    rest = store(map_arrow(rows, _forest(words_per, percent), "a long, b long"), "rest")
    out = signed.select("doc_id", "n_shingles").join(found.withColumnsRenamed({"node": "doc_id"}), "doc_id", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    if not rest.isEmpty():  # links between whole components: their graph is all that is left
        merged = connected_components(rest, "round2").withColumnsRenamed({"node": "component_id", "component": "further"})
        out = out.join(merged, "component_id", "left").select("doc_id", "n_shingles", F.coalesce("further", "component_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))

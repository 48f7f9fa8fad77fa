"""Helpers shared by the operators: tables, shared storage, words, Arrow maps, components."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upswing.sources.storage import shared_path

#: Odd multipliers of a 64-bit mixer (splitmix64).
MIX_A, MIX_B = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
U64 = (1 << 64) - 1
#: Spark's setting that removes the shuffle files of a query once it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What a partition holds at least, on average, when small ones are read together: narrow rows, bytes of texts.
ROWS_TOGETHER, BYTES_TOGETHER = 100_000, 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, what: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    This cuts the lineage (a lost executor costs a re-read) and makes values
    that depend on the order of rows fixed for all later readers. The folder
    lives as long as the lazily read result is needed; the owner of
    ``spark.checkpoint.dir`` removes it. The write's own shuffle files go at its
    end: nothing reads them again, and they would stay until the driver happens to
    collect its garbage.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", what)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def together(df: DataFrame, size: float, each: int) -> DataFrame:
    """``df`` with small partitions read together: as many at most as there are parts of ``each`` in ``size``.

    The number of files then follows the size of the data, not how it happens to be
    dealt (on a local disk Hadoop starts processes for each file, which share an
    executor's memory until they run). Nothing is shuffled, and the order within
    a partition stays.
    """
    return df.coalesce(max(1, math.ceil(size / each)))


def n_shuffle(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release_unused() -> None:
    """Give the memory that Arrow's pool and malloc hold without use back to the system."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()  # trims malloc, which serves numpy


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow`` by a worker that keeps no free memory: the worker waits for its next task beside the others and the executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            release_unused()

    return df.mapInArrow(run, schema)


def binary_texts(column: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of each string of an Arrow array (None for null), without decoding."""
    for value in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()):
        yield value.as_py()


class Vocabulary:
    """Words met so far with dense ids and 64-bit hashes; emptied once it holds ``most`` words."""

    def __init__(self, most: int = 1_000_000):
        self.most = most
        self.reset()

    def reset(self) -> None:
        self.ids: defaultdict[bytes, int] = defaultdict(count().__next__)
        self._hashes = np.empty(1024, dtype=np.uint64)
        self._done = 0

    def encode(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.ids.__getitem__, words), dtype=np.int64, count=len(words))

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """The 64-bit hash of each word."""
        if len(self.ids) > self.most:
            self.reset()
        return self.table(self.encode(words))

    def table(self, ids: np.ndarray) -> np.ndarray:
        self.sync()
        return self._hashes[ids]

    def sync(self) -> np.ndarray:
        """Hashes of all words by id."""
        n = len(self.ids)
        if self._done < n:
            if len(self._hashes) < n:
                self._hashes = np.resize(self._hashes, max(n, 2 * len(self._hashes)))
            new = list(self.ids)[self._done :] if self._done == 0 else _tail(self.ids, n - self._done)
            self._hashes[self._done : n] = np.fromiter(map(xxhash.xxh3_64_intdigest, new), dtype=np.uint64, count=len(new))
            self._done = n
        return self._hashes[:n]


def _tail(d: dict, n: int) -> list:
    """The ``n`` keys added last, in order of their addition."""
    it = reversed(d)
    return [next(it) for _ in range(n)][::-1]


def mix64(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(MIX_A)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_B)
    x ^= x >> np.uint64(31)
    return x


def two_hashes(column: str) -> tuple[F.Column, F.Column]:
    """Two 64-bit hashes of a column with different seeds (a hash's first argument seeds the rest): equal in one, values still differ in the other."""
    return F.xxhash64(column), F.xxhash64(F.lit(7), column)


def unit_hash(*cols) -> F.Column:
    """A fixed pseudo-random number in (0, 1) from the columns' values."""
    bits = F.shiftrightunsigned(F.xxhash64(*cols), 12).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def connected_components(edges: DataFrame, what: str = "components") -> DataFrame:
    """Smallest node reachable from every node of the undirected ``edges`` (a, b): (node, component).

    Labels start as the smallest neighbour; each round takes the smallest label
    among the neighbours and then jumps to the label's own label, so stars
    settle at once and chains in a logarithmic number of rounds. Only the count
    of the edges and whether labels changed reach the driver; each round is a
    written table.
    """
    both = store(
        edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(),
        f"{what}_edges",
    )
    n = both.count()  # there are no more nodes
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component"))
    labels = store(together(labels, n, ROWS_TOGETHER), f"{what}_labels")
    while True:
        near = (
            both.join(labels.withColumnsRenamed({"node": "b", "component": "seen"}), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("seen").alias("seen"))
        )
        pulled = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "seen").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        new = pulled.join(jump, "component", "left").select(
            "node", "was", F.least("component", F.coalesce("further", "component")).alias("component")
        )
        new = store(together(new, n, ROWS_TOGETHER), f"{what}_labels")
        labels = new.select("node", "component")
        if new.where("component <> was").isEmpty():
            return labels

"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 4).

A document of quality weight w gets the key -ln(u) / w with u a fixed
pseudo-random number of its doc_id; ascending keys are a weighted sample without
replacement. A source's target is met by complete epochs first; the rest is the
prefix of its documents in key order whose sizes add up to what is left.

Prefix sums run over (source, key bucket): buckets follow the order of keys, so
a bucket starts where the sums of the earlier ones end, and a source holding a
third of all rows is spread over many tasks. Buckets cut a source's own distribution
of keys, that of its mixture of weights, into equal parts, so that they hold alike
many rows whatever the weights. Texts are measured first and go no further.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upswing.llm.common import ROWS_TOGETHER, binary_texts, map_arrow, store, together, unit_hash

CYCLE = (1.0, 2.0, 3.0)  # weights of the sources by code point, repeating
MAX_EPOCHS = 3
ROWS_PER_BUCKET = 20_000  # aimed rows of a (source, bucket) group
GOOD, POOR, UNKNOWN = 2.0, 0.5, 1.0  # quality weights
WEIGHT_STEP = 1.1  # weights whose ratio is less count as one in the distribution of keys


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = [len(t.split()) if t else 0 for t in binary_texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("source"), pa.array(sizes, pa.int64())],
            names=["doc_id", "source", "size"],
        )


def quality_weights(labels: DataFrame) -> DataFrame:
    """(doc_id, quality): ``GOOD`` where the mean quality label is above a half, else ``POOR``."""
    return (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.when(F.avg("quality") > 0.5, GOOD).otherwise(POOR).alias("quality"))
    )


def source_targets(sizes: DataFrame, cycle: tuple[float, ...] = CYCLE, share: float = 1.0, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, weight, target) from (source, size): water-filling of ``share`` of all sizes.

    A target is min(max_epochs * source_size, level * weight); the level rises
    until the targets add up. Only sums over the sources reach the driver.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # one row per source
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (rank % len(cycle) + 1).cast("int"))
    per = store(per.withColumn("weight", weight), "sources")
    cap = F.col("source_size").cast("double") * max_epochs
    level = 0.0
    while True:
        full = F.lit(level) * F.col("weight") >= cap
        row = per.agg(
            (F.sum("source_size") * share).alias("all"),
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        risen = (row["all"] - row["held"]) / row["open"] if row["open"] else math.inf
        if row["all"] is None or risen <= level or math.isinf(risen):
            break
        level = risen
    return per.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")) if level else F.lit(0.0))


def key_buckets(keyed: DataFrame) -> DataFrame:
    """(source, rows, spread): rows of each source, and its weights with the rows of each.

    The keys of weight w are distributed as 1 - exp(-w * key), those of a source as
    the mean of that over its rows; weights are held in steps of ``WEIGHT_STEP``.
    """
    step = F.floor(F.log("weight") / math.log(WEIGHT_STEP)).alias("step")
    steps = keyed.groupBy("source", step).agg(F.avg("weight").alias("w"), F.count(F.lit(1)).alias("n"))
    return steps.groupBy("source").agg(F.sum("n").alias("rows"), F.collect_list(F.struct("w", "n")).alias("spread"))


def bucket_of(rows_per_bucket: int) -> F.Column:
    """The bucket of a row with key, rows and spread: equal parts of its source's distribution, in order of the keys."""
    below = F.aggregate("spread", F.lit(0.0), lambda total, x: total + x["n"] * (1 - F.exp(-x["w"] * F.col("key")))) / F.col("rows")
    return F.floor(below * F.ceil(F.col("rows") / F.lit(rows_per_bucket))).cast("long")


def mix(
    docs: DataFrame,
    quality: DataFrame | None = None,
    cycle: tuple[float, ...] = CYCLE,
    share: float = 1.0,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 17,
) -> DataFrame:
    """What the mix takes of each row of ``docs`` (doc_id, text, source).

    ``quality`` (doc_id, quality) holds weights > 0; other documents weigh
    ``UNKNOWN``. Returns doc_id, source, size, source_size, target, taken and
    copies (taken = copies * size). A document is taken whole: the one that
    crosses the rest of its source's target is taken if that comes nearer to it.
    Null or empty text has size 0 and no copies; a null source is a source of its
    own (last); a null doc_id takes part like any other; equal rows are separate
    documents, and which of equals comes first does not show in the result.
    Other columns of ``docs`` are not read.
    """
    types = dict(docs.select("doc_id", "source").dtypes)
    sized = map_arrow(docs.select("doc_id", "source", "text"), _sizes, f"doc_id {types['doc_id']}, source {types['source']}, size long")
    if quality is None:
        sized = sized.withColumn("weight", F.lit(UNKNOWN))
    else:
        q = quality.select(F.col("doc_id"), F.col("quality").cast("double").alias("quality"))
        sized = sized.join(q, "doc_id", "left").withColumn("weight", F.coalesce("quality", F.lit(UNKNOWN))).drop("quality")
    key = -F.log(unit_hash("doc_id", F.lit(seed))) / F.col("weight")
    sized = store(sized.withColumn("key", key), "sizes")
    n = sized.count()
    targets = source_targets(sized, cycle, share, max_epochs)
    spread = key_buckets(sized).withColumnRenamed("source", "s")
    sized = sized.join(spread, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    sized = sized.withColumn("bucket", bucket_of(ROWS_PER_BUCKET)).drop("rows", "spread", "weight")
    sized = store(together(sized, n, ROWS_TOGETHER), "sizes")
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("here"))
    before = F.sum("here").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("source", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    sums = sums.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s", "weight")
    sums = sums.withColumnsRenamed({"source": "s", "bucket": "b"})
    local = F.sum("size").over(
        Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    )
    ordered = sized.withColumn("upto", local).join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    middle = F.col("before") + F.col("upto") - F.col("size") / 2  # nearer with it than without it
    extra = F.when((F.col("size") > 0) & (middle <= rest), 1).otherwise(0)
    return (
        ordered.withColumn("epochs", epochs.cast("long"))
        .withColumn("copies", F.when(F.col("size") > 0, F.col("epochs") + extra).otherwise(0).cast("long"))
        .select("doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "key")
    )

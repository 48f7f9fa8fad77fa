"""Genre counts kept as a store, so that new and withdrawn metadata is merged and not recounted.

Kept are signed counts of the metadata rows of each (programme, genre list), a part
for each batch, and the modal genre of the programmes that the batch touched, under
the batch's number. A batch reads the stored counts of its own programmes only and
decides their genre anew; a programme's genre is its last decision. Metadata that
was counted before is never read again and nothing is rewritten.

A batch counts once its row is in the log, which is written last: what a killed
batch left behind is never read, and merging a batch again after it has been logged
does nothing. For a store with one writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upswing.operators.genre import TLEO, programme_titles
from upswing.sources.storage import path_exists

_LOG, _COUNTS, _MODAL = "batch string, number long", f"{TLEO} string, genre_list string, n long, batch string", f"{TLEO} string, genre string, batch string"


def _at(store: str, what: str) -> str:
    return f"{store.rstrip('/')}/{what}"


def genre_batches(spark: SparkSession, store: str) -> DataFrame:
    """The batches that count: batch, number (1, 2, ... in their order)."""
    if not path_exists(spark, _at(store, "log")):
        return spark.createDataFrame([], _LOG)
    return spark.read.schema(_LOG).parquet(_at(store, "log"))


def _committed(spark: SparkSession, store: str, what: str, schema: str) -> DataFrame:
    batches = genre_batches(spark, store)
    if not path_exists(spark, _at(store, what)):
        return spark.createDataFrame([], schema).join(batches, "batch")
    return spark.read.schema(schema).parquet(_at(store, what)).join(F.broadcast(batches), "batch")  # one row for each batch


def _signed(added: DataFrame | None, withdrawn: DataFrame | None) -> DataFrame:
    parts = [programme_titles(m).withColumn("n", F.lit(sign)) for m, sign in ((added, 1), (withdrawn, -1)) if m is not None]
    rows = parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])
    counted = rows.where(F.col(TLEO).isNotNull() & F.col("genre_list").isNotNull()).groupBy(TLEO, "genre_list")
    return counted.agg(F.sum("n").cast("long").alias("n")).where("n <> 0")


def merge_metadata(
    spark: SparkSession, store: str, added: DataFrame | None = None, withdrawn: DataFrame | None = None, batch: str | None = None
) -> None:
    """Add and withdraw metadata rows (a changed row is withdrawn as it was and added as it is).

    ``batch`` names the batch, so that repeating it does nothing. Rows without a
    title or a genre have no part in a modal genre and are left out. Withdrawing
    rows that the store does not hold fails and changes nothing.
    """
    batch = batch or uuid.uuid4().hex
    if (added is None and withdrawn is None) or not genre_batches(spark, store).where(F.col("batch") == batch).isEmpty():
        return
    number = (genre_batches(spark, store).agg(F.max("number")).first()[0] or 0) + 1
    old = _committed(spark, store, "counts", _COUNTS).select(TLEO, "genre_list", "n")
    here = _at(store, f"counts/batch={batch}")
    _signed(added, withdrawn).write.mode("overwrite").parquet(here)
    delta = spark.read.schema(f"{TLEO} string, genre_list string, n long").parquet(here)
    touched = delta.select(TLEO).distinct()
    held = old.join(touched, TLEO, "left_semi").unionAll(delta).groupBy(TLEO, "genre_list").agg(F.sum("n").alias("n"))
    best = F.max_by(F.when(F.col("n") > 0, F.col("genre_list")), F.struct("n", "genre_list"))  # ties as in modal_genre
    decided = held.groupBy(TLEO).agg(best.alias("genre"), F.min("n").alias("least"))
    at = _at(store, f"modal/batch={batch}")
    decided.write.mode("overwrite").parquet(at)
    if not spark.read.parquet(at).where("least < 0").isEmpty():
        raise ValueError(f"batch {batch} withdraws metadata rows that {store} does not hold")
    spark.range(1).select(F.lit(batch).alias("batch"), F.lit(number).cast("long").alias("number")).write.mode("append").parquet(_at(store, "log"))


def stored_genres(spark: SparkSession, store: str) -> DataFrame:
    """(tleo, genre) as ``modal_genre`` gives them for all metadata added and not withdrawn."""
    last = _committed(spark, store, "modal", _MODAL).groupBy(TLEO).agg(F.max_by(F.struct("genre"), "number").alias("last"))
    return last.select(TLEO, "last.genre").where("genre is not null")

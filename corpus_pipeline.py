"""The corpus pipeline: five stages, each one operator over all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from upswing.llm.common import BYTES_TOGETHER, ROWS_TOGETHER, read_table, store, together
from upswing.llm.lang_id import UNDETERMINED, fit, held_out_rows, predict
from upswing.llm.mixing import mix, quality_weights
from upswing.llm.near_dedup import near_duplicates
from upswing.llm.phrase_index import decontaminate
from upswing.llm.queries import tokenizer_path
from upswing.llm.token_store import token_digests, write_tokens
from upswing.sources.storage import shared_path

MIN_SCORE = 0.4  # a document is rejected if no language reaches this share


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: null or letterless texts, or no language above ``MIN_SCORE``."""
    net = fit(docs.where(~held_out_rows()))
    return predict(docs, net).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= MIN_SCORE)).select("row.*")


def _text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def _documents(docs: DataFrame) -> DataFrame:
    """(row, _id, doc_id, text): the rows with a number of each document.

    That is its doc_id, unless rows of one doc_id hold different texts: they are
    different documents, and those rows get a number from doc_id and text. The
    table of such doc_ids is written first, so its size is known and decides how
    it is joined: few of them cost the rows no exchange. A null doc_id stays null
    in ``doc_id``, its rows are numbered by their texts.
    """
    texts = F.xxhash64("text")
    shared = docs.groupBy(F.col("doc_id").alias("_shared")).agg(F.min(texts).alias("_a"), F.max(texts).alias("_b"))
    shared = shared.where("_a <> _b and _shared is not null").select("_shared")
    shared = store(together(shared, docs.count(), ROWS_TOGETHER), "shared")
    own = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2) + F.lit(1 << 62)  # above the usual doc_ids, which go first
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text", own.alias("_own"))
    number = F.when(F.col("doc_id").isNull() | F.col("_shared").isNotNull(), F.col("_own")).otherwise(F.col("doc_id"))
    return rows.join(shared, F.col("doc_id") == F.col("_shared"), "left").select("row", number.alias("_id"), "doc_id", "text")


def _renumbered(rows: DataFrame) -> DataFrame:
    """The documents of ``rows`` (of ``_documents``) with the number of each as its doc_id, and the doc_id itself as ``_doc_id``."""
    fields = [c for c in rows.schema["row"].dataType.names if c != "doc_id"]
    return rows.select(F.col("_id").alias("doc_id"), F.col("doc_id").alias("_doc_id"), *[F.col(f"row.`{c}`").alias(c) for c in fields])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest document of each near-duplicate component (five words, similarity 0.8), one row of it.

    Rows of one doc_id with different texts are different documents. Rows without
    a doc_id are linked with nothing and stay.
    """
    rows = _documents(docs)
    named = rows.where("doc_id is not null")
    dropped = near_duplicates(named.select(F.col("_id").alias("doc_id"), "text"), words_per=5, percent=80).where("not kept")
    named = named.join(dropped.select(F.col("doc_id").alias("_dropped")).distinct(), F.col("_id") == F.col("_dropped"), "left_anti")
    first = F.row_number().over(Window.partitionBy("_id").orderBy(F.xxhash64("text")))
    kept = named.withColumn("_n", first).where("_n = 1").select("row.*").unionAll(rows.where("doc_id is null").select("row.*"))
    return together(kept, _text_bytes(docs), BYTES_TOGETHER)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item, each row by its own text."""
    rows = _documents(docs)
    judged = decontaminate(rows.select(F.col("_id").alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"))
    hit = judged.where("contaminated").select(F.col("doc_id").alias("_hit")).distinct()
    clean = rows.join(hit, F.col("_id") == F.col("_hit"), "left_anti").select("row.*")
    return together(clean, _text_bytes(docs), BYTES_TOGETHER)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it; documents it does not take go.

    Weights come by doc_id; rows of one doc_id with different texts are taken each
    by itself, equal rows equally often (the most of any of them).
    """
    rows = _documents(docs)
    numbered = _renumbered(rows)
    weights = quality_weights(read_table(spark, sf_dir, "labels"))
    by_number = numbered.select("doc_id", "_doc_id").distinct().join(weights.withColumnRenamed("doc_id", "_doc_id"), "_doc_id")
    taken = mix(numbered, by_number.select("doc_id", "quality")).where("copies > 0")
    taken = taken.groupBy(F.col("doc_id").alias("_taken")).agg(F.max("copies").alias("_copies"))
    rows = together(rows.join(taken, F.col("_id") == F.col("_taken")), _text_bytes(docs), BYTES_TOGETHER)
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("row.*")


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token ids of all rows to ORC files and returns, read back: doc_id, start, n_tokens, ids_crc32."""
    path = shared_path(spark, "llm", "tokens")
    write_tokens(docs, path, tokenizer_path())
    return together(token_digests(spark, path), _text_bytes(docs), BYTES_TOGETHER)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_token_files),
]

#: Networks, MinHash and tokenizers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs

"""Line deduplication by a deletion-neighbourhood join (operator 10), in DataFrame operations only.

Two lines are within one edit if they are equal, or leave the same string when
one character is deleted from each (at the same place) or from the longer one. All
these variants are emitted as hashed keys and joined; edit distances are then
verified. A variant's key is made of hashes of the blocks of the line before and
after the deletion and of the block around it, so a long line costs about
length ** 1.5. Two exact prefilters come before: lines within one edit have nearly
equal lengths and the same first or last half; and for some block they agree in all
that lies outside it. Variants are emitted for the blocks that pass only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswing.llm.common import store, two_hashes

BROADCAST_LINES = 200_000  # candidate lines up to which their hashes are broadcast (about 10 MB)
MIN_NEAR = 20  # characters; shorter lines are dropped only as exact copies
BLOCK = 64  # characters; longer lines use the root of their length


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, body, no, line, a, b): all lines that are not blank, with two hashes of different seeds; body is the document's hash."""
    rows = docs.select("doc_id", "body", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    a, b = two_hashes("line")
    return rows.where("trim(line) <> ''").withColumn("a", a).withColumn("b", b)


def _place(doc_id: str = "doc_id") -> Column:
    """Sorts by doc_id (null last), then the document's hash, then the line's number."""
    return F.struct(F.col(doc_id).isNull().alias("late"), F.col(doc_id).alias("doc_id"), "body", "no")


def _halves() -> list[Column]:
    """Keys of a line: for each of the longer lengths a pair can have, its first and last half."""
    n, keys = F.length("line"), []
    for longer in (n, n + 1):
        h = F.floor((longer - 1) / 2).cast("int")  # both lines have as many characters beside the edit
        keys += [
            F.xxhash64(longer, F.lit("first"), F.col("line").substr(F.lit(1), h)),
            F.xxhash64(longer, F.lit("last"), F.col("line").substr(n - h + 1, h)),
        ]
    return keys


def _blocks() -> Column:
    """Structs of a line's blocks, as the longer line of a pair and as the shorter one.

    outer: key of all that lies outside the block; start, width: of the block in
    the longer line; around: the line's part inside it.
    """
    n, line = F.length("line"), F.col("line")

    def blocks(longer: Column, short: int) -> Column:
        size = F.greatest(F.lit(BLOCK), F.ceil(F.sqrt(longer)).cast("int"))

        def block(k: Column) -> Column:
            start = k * size
            width = F.least(size, longer - start)
            tail = longer - start - width
            outer = F.xxhash64(longer, k, line.substr(F.lit(1), start), line.substr(n - tail + 1, tail))
            return F.struct(
                outer.alias("outer"), start.alias("start"), width.alias("width"), line.substr(start + 1, width - short).alias("around"), F.lit(bool(short)).alias("short")
            )

        return F.transform(F.sequence(F.lit(0), F.ceil(longer / size).cast("int") - 1), block)

    return F.concat(blocks(n, 0), blocks(n + 1, 1))


def _variants() -> Column:
    """Structs (v, at) of a block: keys of its one-character deletions (at: where), or of the shorter line's as it is (at: -1)."""
    outer, around = F.col("outer"), F.col("around")
    deleted = F.transform(
        F.sequence(F.lit(1), F.col("width")),
        lambda i: F.struct(
            F.xxhash64(outer, F.concat(F.substr(around, F.lit(1), i - 1), F.substr(around, i + 1))).alias("v"), (F.col("start") + i).alias("at")
        ),
    )
    return F.when(F.col("short"), F.array(F.struct(F.xxhash64(outer, around).alias("v"), F.lit(-1).alias("at")))).otherwise(deleted)


def near_lines(lines: DataFrame) -> DataFrame:
    """(a, b, near): lines with an earlier line within one edit.

    ``lines`` holds distinct lines: a, b (hashes), place (of the first
    occurrence), line.
    """
    blocks = store(lines.select("a", "b", "place", F.inline(_blocks())), "blocks")
    shared = blocks.groupBy("outer").agg(F.count("*").alias("size")).where("size > 1").select("outer")
    blocks = blocks.join(shared, "outer")
    variants = store(blocks.select("a", "b", "place", F.inline(_variants())), "variants")
    # the same place deleted: all lines of the group differ there alone, so the earliest stands for all
    firsts = variants.where("at > 0").groupBy("v", "at").agg(F.min(F.struct("place", "a", "b")).alias("first"), F.count("*").alias("size")).where("size > 1")
    swaps = variants.join(firsts.select("v", "at", "first"), ["v", "at"]).where("place > first.place")
    swaps = swaps.select("a", "b", F.col("first.a").alias("ea"), F.col("first.b").alias("eb"))
    # a deletion that leaves another line: v names that line, so each long line meets one
    short = variants.where("at < 0").select("v", F.struct("place", "a", "b").alias("s")).distinct()
    both = variants.where("at > 0").select("v", F.struct("place", "a", "b").alias("l")).distinct().join(short, "v")
    late, early = F.greatest("l", "s"), F.least("l", "s")
    drops = both.select(late.alias("late"), early.alias("early")).select("late.a", "late.b", F.col("early.a").alias("ea"), F.col("early.b").alias("eb"))
    pairs = swaps.unionAll(drops).distinct()
    texts = lines.select("a", "b", "line")
    other = texts.select(F.col("a").alias("ea"), F.col("b").alias("eb"), F.col("line").alias("earlier"))
    checked = pairs.join(texts, ["a", "b"]).join(other, ["ea", "eb"]).where(F.levenshtein("line", "earlier", 1) == 1)
    return checked.select("a", "b").distinct().withColumn("near", F.lit(True))


def dedup_lines(docs: DataFrame, min_near: int = MIN_NEAR) -> DataFrame:
    """Drop the lines of ``docs`` (doc_id, text) that repeat an earlier line or are within one edit of one.

    Lines end at newlines. The earliest occurrence (by doc_id, then the row's
    hash, then the line's number) stays; later equal lines go, and so do all
    occurrences of a line of at least ``min_near`` characters for which any
    earlier line of that length is one insertion, deletion or substitution away.
    Blank lines always stay. Returns doc_id, n_lines, n_exact, n_near (dropped
    lines by reason; near counts first), text. A null text stays null, with no
    lines; a null doc_id sorts last; equal rows are one document and yield one
    row. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("body", F.xxhash64("doc_id", "text"))
    lines = _lines(docs)
    halves = [F.when(F.length("line") >= min_near, h) for h in _halves()]
    keys = [f"half{k}" for k in range(len(halves))]
    hashed = lines.select("a", "b", _place().alias("place"), *[h.alias(k) for h, k in zip(halves, keys, strict=True)])
    distinct = store(hashed.groupBy("a", "b").agg(F.min("place").alias("place"), F.count("*").alias("size"), *[F.first(k).alias(k) for k in keys]), "lines")
    keyed = distinct.where("half0 is not null").select("a", "b", "place", F.explode(F.array(*keys)).alias("key"))
    common = keyed.groupBy("key").agg(F.count("*").alias("sharing")).where("sharing > 1").select("key")
    some = store(keyed.join(common, "key").select("a", "b", F.col("place").alias("first")).distinct(), "sharing")
    if some.count() <= BROADCAST_LINES:
        some = F.broadcast(some)
    texts = lines.join(some, ["a", "b"]).where(_place() == F.col("first")).select("a", "b", F.col("first").alias("place"), "line")
    near = store(near_lines(store(texts, "candidates")), "near")
    tops = distinct.select("a", "b", "place", "size").join(near, ["a", "b"], "left").where("size > 1 or near")
    tops = store(tops.select("a", "b", "place", F.coalesce("near", F.lit(False)).alias("near")), "repeated")
    dropped = lines.drop("line").join(tops, ["a", "b"]).where(F.col("near") | (_place() != F.col("place")))
    known = F.coalesce("doc_id", F.lit(0).cast("long")).alias("known")  # body tells a null from 0
    per_doc = dropped.select(known, "body", "no", "near").distinct().groupBy("known", "body").agg(
        F.collect_list("no").alias("gone"), F.count(F.when(F.col("near"), 1)).alias("n_near")
    )
    unique = docs.select(known, "body", "doc_id", "text").dropDuplicates(["known", "body"])
    rows = unique.join(per_doc, ["known", "body"], "left")
    parts = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), "gone")
    rows = rows.withColumn("parts", parts)
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get("parts", i)), "\n"))
    zero = F.lit(0).cast("long")
    n_near, n_gone = F.coalesce("n_near", zero), F.coalesce(F.size("gone").cast("long"), zero)
    return rows.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.size("parts")).cast("long").alias("n_lines"),
        (n_gone - n_near).alias("n_exact"),
        n_near.alias("n_near"),
        text.alias("text"),
    )

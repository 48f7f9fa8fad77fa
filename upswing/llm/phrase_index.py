"""Benchmark decontamination by a distributed positional inverted index (operator 1).

``build_index`` stores the postings of every training token. The index is
partitioned by document into segments: a segment holds whole documents, about
``SEGMENT_TOKENS`` tokens, and one row per term with its delta-coded positions.
``search`` looks phrases up: terms are ranked by their frequency over all
segments; a phrase visits only the segments that hold its rarest term, whose
positions, shifted by the term's place in the phrase, are intersected with the
shifted positions of the next rarest, and so on. Exact matches have every term
at its place; proximity matches have every term within ``slop`` of it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upswing.llm.common import ROWS_TOGETHER, Vocabulary, binary_texts, map_arrow, store, together

SEGMENT_TOKENS = 2_000_000
SEGMENT_BYTES = 8 << 20  # of text that a partition holds at least, on average, when the index is built
WINDOW = 10  # words
BLOCK_WINDOWS = 50_000  # phrases searched in a segment at once
BROADCAST_TERMS = 100_000  # terms up to which the list is broadcast (about 3 MB)

_WORD = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
#: Lower-cases A-Z and turns every byte that is not part of a word into a space.
FOLD = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if (b + 32 if 0x41 <= b <= 0x5A else b) in _WORD else 32 for b in range(256))
INDEX_SCHEMA = "segment long, term string, cf long, postings binary, doc_ids array<long>, n_words array<long>"


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text: runs of ASCII digits, letters (lower-cased) and characters beyond ASCII."""
    return text.translate(FOLD).split() if text else []


def pack(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Delta and variable-byte code of ascending runs of the given sizes: bytes, and the bytes of each run."""
    starts = np.cumsum(sizes) - sizes
    deltas = np.diff(values, prepend=0)
    deltas[starts] = values[starts]
    d = deltas.astype(np.uint64)
    n = np.ones(len(d), dtype=np.int64)
    for bits in (7, 14, 21, 28):
        n += d >= np.uint64(1 << bits)
    ends = np.cumsum(n)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    for k in range(5):
        has = n > k
        if not has.any():
            break
        v, last = d[has], n[has] == k + 1
        out[(ends - n)[has] + k] = ((v >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | np.where(last, 0, 128).astype(np.uint8)
    return out, np.add.reduceat(n, starts) if len(starts) else np.empty(0, dtype=np.int64)


def unpack(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, dtype=np.uint8)
    last = b < 128
    ends = np.flatnonzero(last)
    starts = np.concatenate([[0], ends[:-1] + 1])
    shift = (np.arange(len(b)) - np.repeat(starts, ends - starts + 1)) * 7
    return np.cumsum(np.add.reduceat((b & 127).astype(np.int64) << shift, starts))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, done = TaskContext.get().partitionId(), 0
    schema = pa.schema(
        [("segment", pa.int64()), ("term", pa.string()), ("cf", pa.int64()), ("postings", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64()))]
    )
    vocab, tokens, doc_ids, total = Vocabulary(1 << 62), [], [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        segment = (part << 24) + done
        yield pa.RecordBatch.from_arrays(
            [pa.array([segment]), pa.array([None], pa.string()), pa.array([0]), pa.array([None], pa.binary()), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([[len(t) for t in tokens]], pa.list_(pa.int64()))],
            schema=schema,
        )
        ids = np.concatenate(tokens)
        if not len(ids):
            return
        positions = np.argsort(ids, kind="stable")
        cf = np.bincount(ids, minlength=len(vocab.ids))
        data, sizes = pack(positions, cf)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        terms = list(vocab.ids)
        for at in range(0, len(terms), 50_000):  # rows in the order of the file's first use of a term
            to = min(at + 50_000, len(terms))
            cut = offsets[at : to + 1] - offsets[at]
            postings = pa.BinaryArray.from_buffers(
                pa.binary(), to - at, [None, pa.py_buffer(cut.astype(np.int32).tobytes()), pa.py_buffer(data[offsets[at] : offsets[to]].tobytes())]
            )
            none = pa.nulls(to - at, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(to - at, segment)), pa.array(terms[at:to], pa.binary()).cast(pa.string()), pa.array(cf[at:to]), postings, none, none],
                schema=schema,
            )

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), binary_texts(batch.column("text")), strict=True):
            words = words_of(text)
            tokens.append(vocab.encode(words).astype(np.int32))
            doc_ids.append(doc_id)
            total += len(words)
            if total >= SEGMENT_TOKENS or len(doc_ids) >= SEGMENT_TOKENS:
                yield from flush()
                vocab, tokens, doc_ids, total, done = Vocabulary(1 << 62), [], [], 0, done + 1
    if doc_ids:
        yield from flush()


def build_index(docs: DataFrame) -> DataFrame:
    """Write the positional index of ``docs`` (doc_id, text) and return it.

    One row per (segment, term): cf (occurrences) and postings (positions in the
    segment). One more row per segment, with a null term, lists its documents and
    their numbers of words. Null and empty texts are documents of no words.
    Small partitions are read together: the number of segments, and with it that
    of rows, follows the size of the texts and not how they happen to be dealt.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows.coalesce(max(1, math.ceil(size / SEGMENT_BYTES)))
    return store(map_arrow(rows, _segments, INDEX_SCHEMA), "index")


def _windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, phrases = [], []
            for item, text in zip(batch.column("item_id").to_pylist(), binary_texts(batch.column("text")), strict=True):
                words = words_of(text)
                for at in range(max(1, len(words) - window + 1) if words else 0):
                    items.append(item)
                    phrases.append(b" ".join(words[at : at + window]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(phrases, pa.binary()).cast(pa.string())], names=["item_id", "phrase"])

    return run


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (item_id, phrase): runs of ``window`` words; an item of fewer words, but not none, is one phrase."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return map_arrow(rows, _windows(window), "item_id long, phrase string").distinct()


def _near(post: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Whether a value of ``post`` lies in [lo, hi]."""
    at = np.searchsorted(post, lo)
    ok = at < len(post)
    ok[ok] = post[at[ok]] <= hi[ok]
    return ok


def _match(slop: int):
    """Rows sorted by (segment, block, kind): the segment's documents, its postings, then the phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ends, packed, lists = None, np.empty(0, np.int64), {}, {}

        def postings(term: str) -> np.ndarray | None:
            if term not in lists and term in packed:
                lists[term] = unpack(packed[term])
            return lists.get(term)

        def starts_of(terms: list[str], offsets: list[int], slack: int) -> np.ndarray:
            found = postings(terms[0])
            if found is None:
                return np.empty(0, np.int64)
            doc = np.searchsorted(ends, found, side="right")
            first, last = np.concatenate([[0], ends])[doc], ends[doc] - 1
            start = found - offsets[0]
            if not slack:  # the whole phrase lies in the document
                keep = (start >= first) & (start + len(terms) - 1 <= last)
                start, first, last = start[keep], first[keep], last[keep]
            for term, offset in zip(terms[1:], offsets[1:], strict=True):
                post = postings(term)
                if post is None or not len(start):
                    return np.empty(0, np.int64)
                keep = _near(post, np.maximum(start + offset - slack, first), np.minimum(start + offset + slack, last))
                start, first, last = start[keep], first[keep], last[keep]
            return np.maximum(start, first) if slack else start

        for batch in batches:
            out: list[tuple] = []
            cols = [batch.column(c) for c in ("segment", "block", "kind", "name", "postings", "terms", "offsets", "n_words")]
            for at in range(batch.num_rows):
                segment, block, kind = (cols[k][at].as_py() for k in range(3))
                if (segment, block) != key:
                    key, packed, lists = (segment, block), {}, {}
                if kind == 0:
                    ends = np.cumsum(np.array(cols[7][at].as_py(), dtype=np.int64))
                elif kind == 1:
                    packed[cols[3][at].as_py()] = cols[4][at].as_py()
                else:
                    phrase, terms, offsets = cols[3][at].as_py(), cols[5][at].as_py(), cols[6][at].as_py()
                    exact = starts_of(terms, offsets, 0)
                    near = np.setdiff1d(starts_of(terms, offsets, slop), exact) if slop else np.empty(0, np.int64)
                    for found, is_exact in ((exact, True), (near, False)):
                        docs = np.searchsorted(ends, found, side="right")
                        for d in np.unique(docs):
                            base = int(ends[d - 1]) if d else 0
                            out.append((segment, int(d), phrase, len(terms), is_exact, (found[docs == d] - base).tolist()))
            if out:
                s, d, p, n, e, x = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s, pa.int64()), pa.array(d, pa.int64()), pa.array(p), pa.array(n, pa.int64()), pa.array(e), pa.array(x, pa.list_(pa.int64()))],
                    names=["segment", "ordinal", "phrase", "n_terms", "exact", "starts"],
                )

    return run


def search(index: DataFrame, phrases: DataFrame, slop: int = 0) -> DataFrame:
    """Occurrences of ``phrases`` (phrase: words joined by a space) in the index.

    Returns (segment, ordinal of the document in it, phrase, n_terms, exact,
    starts: word positions in the document). With ``slop`` > 0 rows that are not
    exact hold the places where every term lies within ``slop`` words of where
    the phrase, laid at that place by its rarest term, would have it.
    """
    phrases = store(phrases.select("phrase").distinct(), "phrases")
    placed = phrases.select("phrase", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
    terms = placed.select("term").distinct()
    if terms.count() <= BROADCAST_TERMS:
        terms = F.broadcast(terms)
    posted = store(index.where("term is not null").join(terms, "term", "left_semi").select("segment", "term", "cf", "postings"), "postings")
    frequency = posted.groupBy("term").agg(F.sum("cf").alias("cf"))
    plan = (
        placed.join(frequency, "term", "left")
        .groupBy("phrase")
        .agg(F.array_sort(F.collect_list(F.struct("cf", "offset", "term"))).alias("plan"), F.count(F.when(F.col("cf").isNull(), 1)).alias("absent"))
        .where("absent = 0")  # a term that occurs nowhere: no match
    )
    plan = plan.select("phrase", F.col("plan.term").alias("terms"), F.col("plan.offset").alias("offsets"), F.element_at("plan", 1)["term"].alias("rarest"))
    plan = store(together(plan, phrases.count(), ROWS_TOGETHER), "plans")
    blocks = max(1, math.ceil(plan.count() / BLOCK_WINDOWS))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    visits = posted.select("segment", F.col("term").alias("rarest")).join(plan, "rarest")
    none = lambda kind: F.lit(None).cast(kind)
    rows = (
        index.where("term is null")
        .select("segment", every, F.lit(0).alias("kind"), none("string").alias("name"), none("binary").alias("postings"), none("array<string>").alias("terms"), none("array<int>").alias("offsets"), "n_words")
        .unionByName(
            posted.select("segment", every, F.lit(1).alias("kind"), F.col("term").alias("name"), "postings", none("array<string>").alias("terms"), none("array<int>").alias("offsets"), none("array<long>").alias("n_words"))
        )
        .unionByName(
            visits.select("segment", F.expr(f"cast(pmod(xxhash64(phrase), {blocks}) as int)").alias("block"), F.lit(2).alias("kind"), F.col("phrase").alias("name"), none("binary").alias("postings"), "terms", "offsets", none("array<long>").alias("n_words"))
        )
    )
    rows = rows.repartition("segment", "block").sortWithinPartitions("segment", "block", "kind")
    return map_arrow(rows, _match(slop), "segment long, ordinal long, phrase string, n_terms long, exact boolean, starts array<long>")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, item_ids, n_near, contaminated.

    A word inside an exact occurrence of any window of an item is hit; n_near
    counts the windows that only match within ``slop``. Null or empty texts have
    no words and no hits. Items without words have no windows; a null item_id is
    left out of item_ids. Rows that repeat a doc_id are judged each by itself.
    """
    index = build_index(docs)
    windows = store(item_windows(items, window), "windows")
    found = store(search(index, windows, slop), "matches")
    spans = found.where("exact").select("segment", "ordinal", F.explode("starts").alias("start"), "n_terms")
    spans = spans.groupBy("segment", "ordinal", "start").agg((F.col("start") + F.max("n_terms")).alias("end"))
    by_doc = Window.partitionBy("segment", "ordinal").orderBy("start")
    before = F.coalesce(F.max("end").over(by_doc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = F.greatest(F.lit(0), F.col("end") - F.greatest("start", "before"))
    hits = spans.withColumn("before", before).groupBy("segment", "ordinal").agg(F.sum(covered).alias("n_hit"))
    ids = (
        found.where("exact").select("segment", "ordinal", "phrase").join(windows, "phrase")
        .groupBy("segment", "ordinal").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    near = found.where("not exact").groupBy("segment", "ordinal").agg(F.count("*").alias("n_near"))
    rows = index.where("term is null").select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("ordinal", "doc"))
    rows = rows.select("segment", F.col("ordinal").cast("long").alias("ordinal"), "doc.doc_ids", "doc.n_words")
    zero = F.lit(0).cast("long")
    return (
        rows.join(hits, ["segment", "ordinal"], "left").join(ids, ["segment", "ordinal"], "left").join(near, ["segment", "ordinal"], "left")
        .select(
            F.col("doc_ids").alias("doc_id"),
            "n_words",
            F.coalesce("n_hit", zero).alias("n_hit"),
            F.coalesce(F.size("item_ids"), zero).cast("long").alias("n_items"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
            F.coalesce("n_near", zero).alias("n_near"),
            (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
        )
    )

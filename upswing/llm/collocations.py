"""Phrase collocation mining after Toivonen (operator 11).

A sample of the documents proposes the phrases whose count there reaches a
lowered support. A pass over all documents counts the negative border: the phrases
that were not proposed though both phrases one word shorter inside them were
(every single word belongs to one or the other). It counts by hash: a hash whose
count reaches the support is a failure, and its phrases, and what contains them,
may be frequent too. The next pass counts by text, exactly, what was proposed, what
failed and, in the same pass, all that grows from a failure. Afterwards no frequent
phrase can be left out: every phrase inside a frequent one is frequent too, and so
has been proposed, has failed or has grown.

Documents are tokenised once into segments (words as numbers local to a segment).
Hashes and their counts are merged in a task and leave it packed, one row for each
range of hashes; the number of ranges follows the number of tokens, so that the
group that adds up a range stays of one size. Proposals and failures reach the
passes as bits of their hashes, an array of at most 2**MOST_BITS bits whatever
their number. A bit or a hash that stands for two phrases only has a phrase counted
that need not be: all counts that are returned are added up by text.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upswing.llm.common import binary_texts, map_arrow, mix64, n_shuffle, store

SUPPORT, LONGEST, TOP, CONTAINED = 100, 5, 2000, 100
SAMPLE_EVERY = 16  # one document in so many proposes
SLACK = 0.5  # part of the support expected in the sample that a proposal needs
SEGMENT_TOKENS = 500_000
HASH_BITS = 48  # of a phrase's hash; it decides only what is counted
FLUSH = 2_000_000  # hashes that a task merges before it emits them
RANGE_TOKENS = 4_000_000  # tokens for each range of hashes
LEAST_BITS, MOST_BITS, BITS_EACH = 20, 28, 16  # of the filter: limits (powers of two; 15 at least), and aimed bits for each phrase
BREAK = b".,;:!?\n\x0b\x0c\r"
ODD = np.uint64(0x9E3779B97F4A7C15)
NO_LANG = "und"
SEGMENT = "segment long, sampled boolean, langs array<string>, word_langs binary, words binary, tokens binary, size long"
PACKED = "range int, hashes binary, counts binary"
COUNTED = "text string, n long"  # text: lang, a line end, the phrase


def _pack(a: np.ndarray, kind=np.int32) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a, dtype=kind).tobytes())


def _unpack(data: bytes, kind=np.int32) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=kind)


class _Builder:
    """Tokens of documents: 0 ends a piece, words are numbered from 1 within each language."""

    def __init__(self):
        self.numbers, self.langs, self.tokens, self.size = count(1), {}, [], 0

    def add(self, lang: str, text: bytes) -> None:
        if lang not in self.langs:
            self.langs[lang] = defaultdict(self.numbers.__next__, {b"": -1, b"\n": 0})
        words = text.lower().translate(TABLE).replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(self.langs[lang].__getitem__, [*words, b"\n"]), dtype=np.int32, count=len(words) + 1)
        self.tokens.append(ids[ids >= 0])
        self.size += len(self.tokens[-1])

    def row(self, segment: int, sampled: bool) -> tuple:
        total = next(self.numbers) - 1
        words, of = [b""] * total, np.zeros(total, dtype=np.int32)
        for k, known in enumerate(self.langs.values()):
            for word, number in known.items():
                if number > 0:
                    words[number - 1], of[number - 1] = word, k
        return segment, sampled, list(self.langs), _pack(of), b" ".join(words), _pack(np.concatenate(self.tokens)), self.size


TABLE = bytes.maketrans(BREAK + b"\t", b"\n" * len(BREAK) + b" ")


def _tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, done = TaskContext.get().partitionId(), 0
    kinds = [pa.int64(), pa.bool_(), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
    open_ = {True: _Builder(), False: _Builder()}

    def close(sampled: bool) -> pa.RecordBatch:
        nonlocal done
        row = open_[sampled].row((part << 24) + done, sampled)
        open_[sampled], done = _Builder(), done + 1
        names = [f.split()[0] for f in SEGMENT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)

    for batch in batches:
        for lang, sampled, text in zip(batch.column("lang").to_pylist(), batch.column("sampled").to_pylist(), binary_texts(batch.column("text")), strict=True):
            open_[sampled].add(lang, text or b"")
            if open_[sampled].size >= SEGMENT_TOKENS:
                yield close(sampled)
    for sampled, builder in list(open_.items()):
        if builder.tokens:
            yield close(sampled)


def _inside(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(HASH_BITS - int(math.log2(8 * len(bits))))
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _short(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - HASH_BITS)


class _Phrases:
    """The phrases of a segment, by length: of each the columns of its words, its hash and its count."""

    def __init__(self, row: dict):
        self.words = pa.array(row["words"].split(b" ") if row["words"] else [], pa.binary())
        self.langs = pa.array([x.encode() for x in row["langs"]], pa.binary())
        self.lang_of, self.tokens = _unpack(row["word_langs"]), _unpack(row["tokens"])
        seeds = mix64(np.array([xxhash.xxh3_64_intdigest(x) for x in row["langs"]], dtype=np.uint64))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words.to_pylist()), dtype=np.uint64, count=len(self.words))
        self.word_hash = self.hash = _short(mix64(hashes ^ seeds[self.lang_of]))
        self.at = self.tokens.astype(np.int64) - 1  # number of the phrase that begins at each token, or -1
        self.n = np.bincount(self.at[self.at >= 0], minlength=len(self.words))
        self.columns = [np.arange(len(self.words))]

    def longer(self, usable: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Go on to the phrases one word longer whose two parts are ``usable``; returns the parts of each."""
        open_ = (self.at >= 0) & usable[self.at] if len(usable) else np.zeros(len(self.at), dtype=bool)
        places = np.flatnonzero(open_[:-1] & open_[1:])
        which, keys = pd.factorize(self.at[places] * len(self.hash) + self.at[places + 1])
        left, right = keys // max(1, len(self.hash)), keys % max(1, len(self.hash))
        self.columns = [c[left] for c in self.columns] + [self.columns[-1][right]]
        self.hash = _short(mix64(self.hash[left] * ODD + self.word_hash[self.columns[-1]]))
        self.n = np.bincount(which, minlength=len(keys))
        self.at = np.full(len(self.tokens), -1, dtype=np.int64)
        self.at[places] = which
        return left, right

    def by_text(self, some: np.ndarray) -> pa.RecordBatch:
        parts = [self.words.take(pa.array(c[some])) for c in self.columns]
        phrase = pc.binary_join_element_wise(*parts, b" ") if len(parts) > 1 else parts[0]
        langs = self.langs.take(pa.array(self.lang_of[self.columns[0][some]]))
        return _batch(pc.binary_join_element_wise(langs, phrase, b"\n"), self.n[some])

    def by_hash(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.hash[some], self.n[some]

    def all_words(self) -> pa.RecordBatch:
        """Each language's words, as an empty phrase."""
        total = np.bincount(self.lang_of, weights=self.n, minlength=len(self.langs))
        return _batch(pc.binary_join_element_wise(self.langs, b"", b"\n"), total)


def _batch(texts: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([texts.cast(pa.string()), pa.array(n.astype(np.int64))], names=["text", "n"])


def _sampled(p: _Phrases) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All phrases of a sampled segment."""
    for size in range(1, LONGEST + 1):
        every = np.ones(len(p.hash), dtype=bool)
        yield p.by_hash(every)
        if size < LONGEST:
            p.longer(every)


def _border(p: _Phrases, proposed: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The phrases that were not proposed though both their parts were."""
    for size in range(1, LONGEST + 1):
        inside = _inside(proposed, p.hash)
        yield p.by_hash(~inside)
        if size < LONGEST:
            p.longer(inside)


def _texts(p: _Phrases, proposed: np.ndarray, failed: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What was proposed, what failed, what contains a failure, and the number of words."""
    yield p.all_words()
    seen = np.ones(len(p.hash), dtype=bool)  # proposed or border
    for size in range(1, LONGEST + 1):
        inside = seen & _inside(proposed, p.hash)
        usable = inside | ~seen | _inside(failed, p.hash)
        yield p.by_text(usable)
        if size < LONGEST:
            left, right = p.longer(usable)
            seen = inside[left] & inside[right]


def _sums(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, ascending, and the sum of the counts of each."""
    hashes, counts = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(hashes)
    hashes = hashes[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    return hashes[first], np.add.reduceat(counts[order], first)


def _frequent_hashes(segments: DataFrame, support: int, count_in, *filters) -> DataFrame:
    """(hash) of those whose counts, as ``count_in`` yields them of each segment, reach ``support``."""
    ranges = max(1, math.ceil((segments.agg(F.sum("size")).first()[0] or 0) / RANGE_TOKENS))

    def packed(hashes: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        merged, n = _sums(hashes, counts)
        of = ((merged >> np.uint64(HASH_BITS - 24)) * np.uint64(ranges) >> np.uint64(24)).astype(np.int64)
        cuts = np.searchsorted(of, np.arange(ranges + 1))
        some = [(k, a, b) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, *_ in some], pa.int32()),
                pa.array([_pack(np.diff(merged[a:b], prepend=np.uint64(0)), np.uint64) for _, a, b in some], pa.binary()),
                pa.array([_pack(n[a:b], np.int64) for _, a, b in some], pa.binary()),
            ],
            names=["range", "hashes", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, held = [], [], 0
        for batch in batches:
            for row in batch.to_pylist():
                for more, n in count_in(_Phrases(row), *(f.value for f in filters)):
                    hashes.append(more)
                    counts.append(n)
                    held += len(more)
                if held >= FLUSH:
                    yield packed(hashes, counts)
                    hashes, counts, held = [], [], 0
        if held:
            yield packed(hashes, counts)

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        hashes, n = _sums([np.cumsum(_unpack(r["hashes"], np.uint64)) for r in rows], [_unpack(r["counts"], np.int64) for r in rows])
        return pa.table({"hash": hashes[n >= support].astype(np.int64)})

    return map_arrow(segments, run, PACKED).groupBy("range").applyInArrow(merge, "hash long")


def _count_texts(segments: DataFrame, support: int, *filters) -> DataFrame:
    """(text, n) with ``n >= support``, and each language's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _texts(_Phrases(row), *(f.value for f in filters))

    counted = map_arrow(segments, run, COUNTED).groupBy("text").agg(F.sum("n").alias("n"))
    return counted.where((F.col("n") >= support) | F.col("text").endswith("\n"))


def _filter(hashes: DataFrame) -> np.ndarray:
    """Bits of the column ``hash``, from bitmaps of 4 KB made by Spark: at most 2**MOST_BITS bits reach the driver."""
    aimed = math.ceil(math.log2(max(1, BITS_EACH * hashes.count())))
    power = min(MOST_BITS, max(LEAST_BITS, aimed))
    bits = np.zeros(1 << (power - 3), dtype=np.uint8)
    place = F.shiftrightunsigned("hash", HASH_BITS - power) + 1  # the bitmap functions number from one
    maps = hashes.groupBy(F.bitmap_bucket_number(place).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("map"))
    for k, data in maps.collect():
        bits[(k - 1) * 4096 : k * 4096] |= np.frombuffer(data, dtype=np.uint8)
    return bits


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, sample_every: int = SAMPLE_EVERY) -> DataFrame:
    """(lang, phrase, size, n) of all phrases of 1 to ``LONGEST`` words with ``n >= support``; size 0 holds a language's words."""
    share = docs.sparkSession.sparkContext.broadcast
    sampled = F.pmod(F.xxhash64("doc_id", "text"), F.lit(sample_every)) == 0
    lang = F.coalesce(F.col("lang"), F.lit(NO_LANG)).alias("lang")
    segments = store(map_arrow(docs.select(lang, sampled.alias("sampled"), "text"), _tokenise, SEGMENT), "segments", ("sampled",))
    lowered = max(2, int(SLACK * support / sample_every))
    proposed = share(_filter(store(_frequent_hashes(segments.where("sampled"), lowered, _sampled), "proposed")))
    failed = share(_filter(store(_frequent_hashes(segments, support, _border, proposed), "failed")))
    found = _count_texts(segments, support, proposed, failed)
    found = found.withColumn("phrase", F.substring_index("text", "\n", -1))  # words hold no line end, languages may
    lang = F.expr("substring(text, 1, length(text) - length(phrase) - 1)").alias("lang")
    return found.select(lang, "phrase", F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " "))).alias("size"), "n")


def collocations(
    docs: DataFrame, support: int = SUPPORT, top: int = TOP, contained: int = CONTAINED, sample_every: int = SAMPLE_EVERY
) -> DataFrame:
    """Each language's best phrases of ``docs`` (doc_id, text, lang): lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends,
    and the pieces into words at spaces and tabs. ``a`` counts the phrase, ``l`` and
    ``r`` the parts of its lowest-scoring cut (ties: the first), ``n`` the words of
    the language; score is floor(1000 * a * n / (l * r)), in exact arithmetic. A
    phrase inside a longer frequent one with at least ``contained`` percent of its
    count is left out. Ranked by score and a, descending, then phrase by its bytes.

    A null lang counts as ``und``; a null or empty text has no words; texts of any
    length are read whole; equal rows count each; a null doc_id takes part; other
    columns are not read. An empty table gives an empty one.
    """
    known = store(frequent_phrases(docs, support, sample_every), "frequent")
    totals = known.where("size = 0").select("lang", F.col("n").alias("total"))
    chosen = known.where("size > 1").withColumnRenamed("n", "a")
    inner = F.array(F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring_index(phrase, ' ', 1 - size)"))
    cover = chosen.where("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("over"))
    cover = cover.groupBy("lang", "phrase").agg(F.max("over").alias("over"))
    chosen = chosen.join(cover, ["lang", "phrase"], "left").where(f"over is null or 100 * over < {int(contained)} * a").drop("over")
    cuts = chosen.withColumn("k", F.explode(F.expr("sequence(1, size - 1)"))).withColumns(
        {"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - size)")}
    )
    for part, as_ in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(known.where("size > 0").select("lang", F.col("phrase").alias(part), F.col("n").alias(as_)), ["lang", part])
    cuts = cuts.join(totals, "lang")
    score = F.expr("(cast(1000 as decimal(38,0)) * a * total) div (cast(l as decimal(38,0)) * r)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a", F.col("total").alias("n")).agg(lowest)
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(n_shuffle(docs.sparkSession)))  # no task holds a whole language
    best = scored.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    best = best.where(F.col("rank") <= top).drop("part")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

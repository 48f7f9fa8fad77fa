"""Token ids in ORC files (operator 3).

Documents are sorted by doc_id over range partitions and encoded in that order;
each partition is one ORC file whose integer columns are run-length encoded.
Stripes are the unit of parallel reads; row indexes and Bloom filters on doc_id
let readers skip stripes and row groups for a lookup. The place of a document in
the whole sequence is its place in its file plus the sizes of the files before.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain, pairwise
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from upswing.llm.common import map_arrow

END_ID = 1
BYTES = 1 << 20  # of texts are written out together
LOOKED_UP = 8 << 20  # bytes of texts whose distinct chunks are looked up together
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII, without the apostrophe, which may begin a contraction
ALPHABETS = [*range(0x250), *range(0x400, 0x530)]  # of letters that join with no other letter
TOGETHER = 1000  # new chunks that one call encodes
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
SCHEMA = "part int, doc_id long, place long, n_tokens long, ids array<int>"


class ChunkEncoder:
    """Encodes texts chunk by chunk, each distinct chunk once.

    For vocabularies whose normaliser and pre-tokenizer never look across ASCII
    white space and drop it, and lower-case the text: then a text's ids are those
    of its white-space chunks one after the other, and A-Z can be lower-cased
    first. Texts that may hold a special token's string are encoded whole. A word
    before final marks is a chunk of its own where the pre-tokenizer cuts between
    them: not after letters that normalisation ends with a combining mark, which
    goes with the marks. The known chunks are an Arrow array: numbering those of
    many texts after them finds both the known and the new.
    """

    def __init__(self, path: str, most: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cuts: dict[str, bool] = {}  # by a word's last letter and the mark after it
        self.forms = self._forms()
        self.plain = "^[" + "".join(map(chr, self.forms)) + "]+$" if self.forms else "a^"  # "a^" matches nothing
        self.reset()

    def reset(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.first, self.size, self.pool = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)  # of each chunk: its run in the pool

    @property
    def chunks(self) -> list[str]:
        return self.known.to_pylist()

    def forget(self) -> None:
        """Drop the chunks met late: the frequent ones are among the early."""
        kept = self.most // 2
        self.known, self.size = self.known.take(pa.array(np.arange(kept))), self.size[:kept].copy()
        self.pool = self.pool[_runs(self.first[:kept], self.size)]
        self.first = np.cumsum(self.size) - self.size

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.int32)

    def _pieces(self, text: str) -> list[str]:
        """What the model is given of a text."""
        return [piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))]

    def _forms(self) -> dict[int, str]:
        """What the model is given of each Latin and Cyrillic letter that stays one piece with its neighbours.

        Normalisation joins none of these letters with another one, so a word of
        them is given to the model letter by letter. Not with letters beside marks
        or of other scripts, which the whole tokenizer encodes.
        """
        forms = {}
        for letter in filter(str.isalpha, map(chr, ALPHABETS)):
            one, a = self._pieces(letter), self._pieces("a")
            if len(one) == len(a) == 1 and [self._pieces(x) for x in (2 * letter, letter + "a", "a" + letter)] == [[2 * one[0]], [one[0] + a[0]], [a[0] + one[0]]]:
                forms[ord(letter)] = one[0]
        return forms

    def _cut(self, end: str) -> bool:
        """Whether the tokenizer, asked once for each pair, cuts between a word's last letter and the mark after it.

        The letter alone answers for all words: where it composes with the one before (Hangul), the result is a letter too.
        """
        if end not in self.cuts:
            self.cuts[end] = self._pieces(end)[-1] == end[-1]
        return self.cuts[end]

    def _words(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of plain letters one after the other and the number of each: each is one piece, which the model takes at once."""
        found = list(map(self.model.tokenize, " ".join(some).translate(self.forms).split(" ")))
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(map(attrgetter("id"), chain.from_iterable(found)), dtype=np.int32, count=sizes.sum()), sizes

    def _any(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of any chunks one after the other and the number of each, told apart by their places in the text."""
        encoded = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
        places = np.cumsum(np.fromiter(map(len, some), dtype=np.int64, count=len(some)) + 1)  # where the next chunk starts
        starts = np.fromiter(chain.from_iterable(encoded.offsets), dtype=np.int64, count=2 * len(encoded))[::2]
        return np.array(encoded.ids, dtype=np.int32), np.diff(np.searchsorted(starts, places), prepend=0)

    def _learn(self, new: pa.Array) -> None:
        """Encode chunks not met before; they are numbered after the known ones."""
        plain = pc.match_substring_regex(new, self.plain).to_numpy(zero_copy_only=False)
        words, found, order = new.to_numpy(zero_copy_only=False), [], []
        for encode, at in ((self._words, np.flatnonzero(plain)), (self._any, np.flatnonzero(~plain))):
            order.append(at)
            found += [encode(words[at[k : k + TOGETHER]].tolist()) for k in range(0, len(at), TOGETHER)]
        sizes, order = np.concatenate([sizes for _, sizes in found]), np.concatenate(order)
        first, size = np.empty_like(sizes), np.empty_like(sizes)
        first[order], size[order] = len(self.pool) + np.cumsum(sizes) - sizes, sizes
        self.known = pa.concat_arrays([self.known, new])
        self.first, self.size = np.concatenate([self.first, first]), np.concatenate([self.size, size])
        self.pool = np.concatenate([self.pool, *[ids for ids, _ in found]])

    def _numbers(self, parts: pa.Array) -> np.ndarray:
        """The number of each part among the known chunks, after learning the new ones."""
        known = len(self.known)
        both = pa.concat_arrays([self.known, parts]).dictionary_encode()
        if len(both.dictionary) > known:
            self._learn(both.dictionary.slice(known).take(pa.array(np.arange(len(both.dictionary) - known))))
        return both.indices.to_numpy()[known:]

    def _parts(self, chunks: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Each chunk in two: a word before final marks and the marks if they are cut, else itself and an empty string."""
        words = pc.utf8_rtrim(chunks, MARKS)
        split = pc.and_(pc.less(pc.binary_length(words), pc.binary_length(chunks)), pc.utf8_is_alpha(words))
        at = pc.indices_nonzero(split)
        if not len(at):
            return chunks, pa.array([""] * len(chunks), chunks.type)
        some = words.take(at)
        sizes = pc.binary_length(some).to_numpy()
        whole = chunks.take(at)
        offsets = np.frombuffer(whole.buffers()[1], dtype=np.int64)[: len(whole) + 1]
        rests = (offsets[1:] - offsets[:-1]) - sizes
        ends = np.cumsum(rests)
        data = np.frombuffer(whole.buffers()[2], dtype=np.uint8)
        data = data[np.arange(ends[-1]) + np.repeat(offsets[:-1] + sizes - (ends - rests), rests)]
        marks = pa.LargeStringArray.from_buffers(len(whole), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))
        pairs = pc.binary_join_element_wise(pc.utf8_slice_codeunits(some, -1), pc.utf8_slice_codeunits(marks, 0, 1), pa.scalar("", chunks.type)).dictionary_encode()
        cut = np.array([self._cut(x) for x in pairs.dictionary.to_pylist()], dtype=bool)[pairs.indices.to_numpy()]
        split = np.zeros(len(chunks), dtype=bool)
        split[at.to_numpy()[cut]] = True
        split, cut = pa.array(split), pa.array(cut)
        rest = pc.replace_with_mask(pa.array([""], chunks.type).take(pa.array(np.zeros(len(chunks), np.int64))), split, marks.filter(cut))
        return pc.replace_with_mask(chunks, split, some.filter(cut)), rest

    def lists(self, texts: pa.Array, end: tuple[int, ...] = ()) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of each of ``texts`` (strings without nulls), each followed by ``end``: for some texts after the other, the size of each and all ids.

        Each distinct part of a chunk is looked up once for all of ``texts``.
        """
        if len(self.known) > self.most:
            self.forget()
        texts = texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts))))  # a copy of its own: kernels on slices have read beyond them
        lowered = pc.ascii_lower(texts)
        own = {}
        for special in self.special:
            for k in np.flatnonzero(pc.match_substring(lowered, special).to_numpy(zero_copy_only=False)):
                own[int(k)] = self.whole(texts[int(k)].as_py())
        upto = np.cumsum(pc.binary_length(lowered).to_numpy())
        split = pc.ascii_split_whitespace(lowered)
        del texts, lowered
        offsets, flat = split.offsets.to_numpy() - split.offsets[0].as_py(), split.flatten().dictionary_encode()
        del split
        places, distinct = flat.indices.to_numpy(), len(flat.dictionary)
        numbers = self._numbers(pa.concat_arrays(self._parts(flat.dictionary))).reshape(2, distinct).T
        # the ids of the distinct chunks one after the other, then those of all
        size = self.size[numbers]
        pool = self.pool[_runs(self.first[numbers].ravel(), size.ravel())]
        size = size.sum(axis=1)
        first = np.cumsum(size) - size
        del numbers, flat
        at = 0
        while at < len(upto):  # pieces of about BYTES, of one text at least
            rows = max(1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BYTES, side="right")) - at)
            chunks = places[offsets[at] : offsets[at + rows]]
            sizes = size[chunks]
            ids = pool[_runs(first[chunks], sizes)]
            cuts = np.concatenate([[0], np.cumsum(sizes)])[offsets[at : at + rows + 1] - offsets[at]]
            if any(at <= k < at + rows for k in own):
                each = [own.get(at + k, ids[a:b]) for k, (a, b) in enumerate(pairwise(cuts))]
                ids, cuts = np.concatenate(each), np.cumsum([0, *map(len, each)])
            if end:
                ids = np.insert(ids, np.repeat(cuts[1:], len(end)), np.tile(np.array(end, dtype=np.int32), rows))
            yield np.diff(cuts) + len(end), ids
            at += rows

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each of ``texts`` (strings without nulls)."""
        return [ids[b - n : b] for sizes, ids in self.lists(texts) for n, b in zip(sizes, np.cumsum(sizes), strict=True)]


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of runs of the given sizes, one run after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


_ENCODERS: dict[str, ChunkEncoder] = {}  # kept by a worker between its tasks


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = ChunkEncoder(path)
        encoder = _ENCODERS[path]
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string()).fill_null("")
            upto = np.cumsum(pc.binary_length(texts).to_numpy())
            total, at = int(upto[-1]) if len(upto) else 0, 0
            most = max(1, total / max(1, round(total / LOOKED_UP)))  # equal parts: each costs a numbering of all known chunks
            while at < batch.num_rows:
                before = upto[at - 1] if at else 0
                rows = min(batch.num_rows, int(np.searchsorted(upto, before + most)) + 1) - at
                for sizes, ids in encoder.lists(texts.slice(at, rows), (end_id,)):
                    ends = np.cumsum(sizes)
                    places = place + ends - sizes
                    place += int(ends[-1])
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(sizes), part, dtype=np.int32)), batch.column("doc_id").slice(at, len(sizes)), pa.array(places), pa.array(sizes), lists],
                        names=["part", "doc_id", "place", "n_tokens", "ids"],
                    )
                    at += len(sizes)

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Write the token ids of ``docs`` (doc_id, text) to ORC files under ``path``, in ascending doc_id order.

    Null and empty texts are the end id alone. A null doc_id sorts first; rows of
    equal doc_id follow each other in the order of their texts. Other columns
    are not read. A task that is run again writes the same rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    map_arrow(rows, _encode(tokenizer, end_id), SCHEMA).write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The written rows: part, doc_id, place, n_tokens, ids. Filters on doc_id prune stripes and row groups."""
    return spark.read.schema(SCHEMA).orc(path)


def with_starts(rows: DataFrame, tokens: DataFrame) -> DataFrame:
    """Adds start to ``rows`` (part, place, ...): the number of ids of all documents before it.

    ``tokens`` is the table as read; the window runs over one row per file.
    """
    sizes = tokens.groupBy("part").agg(F.sum("n_tokens").alias("here"))
    before = F.sum("here").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    return rows.join(bases, "part").withColumn("start", F.col("base") + F.col("place")).drop("base")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        values, offsets = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
        data = values.astype("<u4", copy=False)
        crc = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        sizes = pa.array(np.diff(offsets).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("doc_id"), batch.column("place"), sizes, pa.array(crc, pa.int64())],
            names=["part", "doc_id", "place", "n_tokens", "ids_crc32"],
        )


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (unsigned, of little-endian 32-bit ids)."""
    tokens = read_tokens(spark, path)
    rows = map_arrow(tokens.select("part", "doc_id", "place", "ids"), _digest, "part int, doc_id long, place long, n_tokens long, ids_crc32 long")
    return with_starts(rows, tokens).select("doc_id", "start", "n_tokens", "ids_crc32")

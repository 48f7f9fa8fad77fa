"""Language-model scoring by Katz backoff (operator 8).

A bigram model over white-space words with Good-Turing discounted counts:
log p(w | h) is that of the discounted count if (h, w) was seen in training, and
else backs off to log alpha(h) + log p(w), where alpha(h) makes the
probabilities after h add up to one; after an unseen h it is log p(w) alone.
Unigrams are discounted alike; what they leave is the probability of the one
class of unknown words.

Documents are tokenised once into segments (whole documents, about
``SEGMENT_TOKENS`` tokens; words as numbers local to the segment). A segment asks
the count tables, partitioned by the hash of the n-gram, for each of its distinct
n-grams once: a frequent n-gram costs one entry per segment, so there is no hot
key. The answers hold the corpus counts, and name one segment as the owner of each
distinct bigram. Owners add up, for each history, the discounted mass and the
unigram mass of its followers; tables partitioned by the history's hash turn the
sums into alpha(h), which answers the tokens that back off.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswing.llm.common import Vocabulary, binary_texts, map_arrow, mix64, store

SEGMENT_TOKENS = 1_500_000
SHARD_TOKENS = 1_500_000  # corpus tokens for each partition of the count tables
CUTOFF = 5  # counts up to this one are Good-Turing discounted
END, START = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b" end of text", b" start of text"))  # no words: they hold spaces
DOCS = "segment long, doc_ids array<long>, train array<boolean>, sizes array<int>, words binary, tokens binary"


def _pack(a: np.ndarray) -> bytes:
    """Compressed, the first byte of all values before the second: high bytes vary little."""
    planes = np.ascontiguousarray(a).reshape(-1, 1).view(np.uint8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.frombuffer(planes.reshape(np.dtype(kind).itemsize, -1).T.tobytes(), dtype=kind)


def _tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments: the distinct words' hashes (end and start first), and each document's words as numbers."""
    part, done = TaskContext.get().partitionId(), 0
    schema = pa.schema(
        [("segment", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())), ("words", pa.binary()), ("tokens", pa.binary())]
    )
    vocab, docs, train, tokens, total = Vocabulary(1 << 62), [], [], [], 0

    def segment() -> pa.RecordBatch:
        words = np.concatenate([np.array([END, START], dtype=np.uint64), vocab.sync()])
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 24) + done]), pa.array([docs], pa.list_(pa.int64())), pa.array([train], pa.list_(pa.bool_())), pa.array([[len(t) for t in tokens]], pa.list_(pa.int32())),
             pa.array([words.tobytes()], pa.binary()), pa.array([_pack(np.concatenate(tokens))], pa.binary())],
            schema=schema,
        )

    for batch in batches:
        for doc, learn, text in zip(batch.column("doc_id").to_pylist(), batch.column("train").to_pylist(), binary_texts(batch.column("text")), strict=True):
            words = text.lower().split() if text else []
            ids = np.zeros(len(words) + 1, dtype=np.int32)  # the last is the end, number 0
            ids[:-1] = vocab.encode(words) + 2
            docs.append(doc)
            train.append(learn)
            tokens.append(ids)
            total += len(ids)
            if total >= SEGMENT_TOKENS:
                yield segment()
                vocab, docs, train, tokens, total, done = Vocabulary(1 << 62), [], [], [], 0, done + 1
    if docs:
        yield segment()


class Segment:
    """A segment with its distinct bigrams; the same arrays each time it is read."""

    def __init__(self, row: dict, shards: int):
        self.doc_ids, self.train = row["doc_ids"], np.array(row["train"], dtype=bool)
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        self.words = np.frombuffer(row["words"], dtype=np.uint64)
        self.tokens = _unpack(row["tokens"], np.int32).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.starts] = 1
        learn = np.repeat(self.train, self.sizes)
        self.pair_of, pairs = pd.factorize(before * len(self.words) + self.tokens)
        del before
        self.pair_of = self.pair_of.astype(np.int32)
        all_counts = np.bincount(self.pair_of, minlength=len(pairs))
        self.h, self.w = pairs // len(self.words), pairs % len(self.words)
        self.pair_train = np.bincount(self.pair_of, weights=learn, minlength=len(pairs)).astype(np.int64)
        self.word_train = np.bincount(self.tokens, weights=learn, minlength=len(self.words)).astype(np.int64)
        self.word_train[1] = self.train.sum()
        held = np.zeros(len(self.words), dtype=bool)  # histories that held-out documents have
        held[self.h[all_counts > self.pair_train]] = True
        self.held = held
        self.word_order, self.word_cut = _dealt(self.words, shards)
        self.pair_hash = mix64(mix64(self.words[self.h]) * np.uint64(0x9E3779B97F4A7C15) + self.words[self.w])
        self.pair_order, self.pair_cut = _dealt(self.pair_hash, shards)


def _dealt(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of ``keys`` by shard, then key, and where each shard starts in it."""
    shard = (mix64(keys ^ np.uint64(0xA5A5A5A5)) % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((keys, shard))
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def _six(keys: np.ndarray) -> bytes:
    """The high 48 bits of ascending keys, as differences; a shard fixes more bits as tables grow."""
    return _pack(np.diff(keys >> np.uint64(16), prepend=np.uint64(0)))


def _from_six(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


def _ask(shards: int):
    """For each segment and shard: the n-grams it asks for with its own training counts (times 2, plus a mark)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = Segment(row, shards)
                out = []
                words = s.words[s.word_order]
                marks = (2 * s.word_train + s.held)[s.word_order].astype(np.uint32)
                pairs = s.pair_hash[s.pair_order]
                own = s.pair_train[s.pair_order].astype(np.uint32)
                for k in range(shards):
                    a, b = s.word_cut[k : k + 2]
                    c, d = s.pair_cut[k : k + 2]
                    if b > a or d > c:
                        out.append((row["segment"], k, words[a:b].tobytes(), _pack(marks[a:b]), _six(pairs[c:d]), _pack(own[c:d])))
                yield _batch(out, ["segment", "shard", "words", "marks", "pairs", "own"], [pa.int64(), pa.int32(), *[pa.binary()] * 4])

    return run


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _spectrum(counts: np.ndarray) -> list[int]:
    """Numbers of types with counts 1 to CUTOFF + 1, of all types, and the sum of all counts."""
    seen = counts[counts > 0]
    return [int(x) for x in np.bincount(np.minimum(seen, CUTOFF + 2), minlength=CUTOFF + 3)[1 : CUTOFF + 2]] + [len(seen), int(seen.sum())]


def _count(table: pa.Table) -> pa.Table:
    """One shard: adds up all segments' counts; answers each segment in the order of its question."""
    rows = table.to_pylist()
    out = []
    words = [np.frombuffer(r["words"], dtype=np.uint64) for r in rows]
    marks = [_unpack(r["marks"], np.uint32) for r in rows]
    types, at = np.unique(np.concatenate(words), return_inverse=True)
    mark = np.concatenate(marks).astype(np.int64)
    totals = np.bincount(at, weights=mark >> 1, minlength=len(types)).astype(np.int64)
    held = np.bincount(at, weights=mark & 1, minlength=len(types)) > 0
    word_answer = (2 * totals + held)[at].astype(np.uint64)
    no_start = totals[types != START]
    asked = [_from_six(r["pairs"]) for r in rows]
    pairs = np.concatenate(asked)
    own = np.concatenate([_unpack(r["own"], np.uint32) for r in rows]).astype(np.int64)
    ptypes, pat = np.unique(pairs, return_inverse=True)
    ptotals = np.bincount(pat, weights=own, minlength=len(ptypes)).astype(np.int64)
    learned = np.flatnonzero(own > 0)
    owner = np.full(len(ptypes), -1)
    owner[pat[learned[::-1]]] = learned[::-1]  # the first that learned it
    pair_answer = (2 * ptotals[pat] + (owner[pat] == np.arange(len(pat)))).astype(np.uint64)
    i = j = 0
    for r, w, p in zip(rows, words, asked, strict=True):
        n = len(p)
        out.append((r["segment"], r["shard"], _pack(word_answer[i : i + len(w)]), _pack(pair_answer[j : j + n]), None, None))
        i, j = i + len(w), j + n
    out.append((None, rows[0]["shard"], None, None, _spectrum(no_start), _spectrum(ptotals)))
    names = ["segment", "shard", "words", "pairs", "word_spectrum", "pair_spectrum"]
    return pa.Table.from_batches([_batch(out, names, [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())])])


@dataclass
class Discount:
    """Good-Turing discounts: ``kept[r]`` is what a count r <= CUTOFF becomes; larger counts lose ``loss``.

    Copies make the numbers of types with counts 1, 2, 3, ... uneven, so Turing's
    estimate uses the line fitted to their logarithms.
    """

    kept: np.ndarray
    loss: float
    total: int  # of all counts
    spare: float  # the discounted mass, in counts

    @classmethod
    def of(cls, spectrum: list[int]) -> Discount:
        n, types, total = [0, *spectrum[: CUTOFF + 1]], spectrum[-2], spectrum[-1]
        r = np.arange(1, CUTOFF + 2)
        have = np.array(n[1:]) > 0
        slope = np.polyfit(np.log(r[have]), np.log(np.array(n[1:])[have]), 1)[0] if have.sum() > 1 else 0.0
        if slope < -1:  # Turing's estimate (r + 1) n(r + 1) / n(r) on the fitted line, Katz's discount from it
            turing, ratio = (1 + 1 / r[:-1]) ** (slope + 1), (CUTOFF + 1) ** (slope + 1)
            kept = np.concatenate([[0], r[:-1] * (turing - ratio) / (1 - ratio)])
        else:  # too few counts for a falling line: half a count each
            kept = np.maximum(np.arange(CUTOFF + 1) - 0.5, 0)
        lost = np.arange(CUTOFF + 1) - kept
        loss = float(lost[CUTOFF])  # larger counts lose as much as the largest discounted one, so every history keeps mass
        spare = sum(n[r] * lost[r] for r in range(1, CUTOFF + 1)) + (types - sum(n[1 : CUTOFF + 1])) * loss
        return cls(kept, loss, total, float(spare))

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts <= CUTOFF, self.kept[np.minimum(counts, CUTOFF)], counts - self.loss)


def _by_shard(rows: list[dict], column: str, cut: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The answers of all shards, put back in the segment's own order."""
    out = np.zeros(len(order), dtype=np.int64)
    for r in rows:
        a, b = cut[r["shard"]], cut[r["shard"] + 1]
        out[order[a:b]] = _unpack(r[column], np.uint64).astype(np.int64)
    return out


def _score(shards: int, uni: Discount, bi: Discount, n_types: int):
    """Segments with the answers: scores of what was seen; sums for alpha by history; the tokens that back off."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            s, answers = Segment(row, shards), right.to_pylist()
            word = _by_shard(answers, "words", s.word_cut, s.word_order)
            pair = _by_shard(answers, "pairs", s.pair_cut, s.pair_order)
            c_word, asked, c_pair, owned = word >> 1, (word & 1) > 0, pair >> 1, (pair & 1) > 0
            unknown = max(uni.spare, 1e-9) / max(uni.total, 1)
            p_word = np.where(c_word > 0, uni(c_word) / max(uni.total, 1), unknown)
            # what owners add up for the histories that held-out documents ask for
            sums = owned & asked[s.h]
            lost = np.bincount(s.h[sums], weights=c_pair[sums] - bi(c_pair[sums]), minlength=len(s.words))
            mass = np.bincount(s.h[sums], weights=p_word[s.w[sums]], minlength=len(s.words))
            given = np.bincount(s.h[sums], minlength=len(s.words)) > 0
            seen = (c_pair > 0) & (c_word[s.h] > 0)  # a history that was never met has no bigrams
            with np.errstate(divide="ignore", invalid="ignore"):
                log = np.where(seen, np.log10(bi(c_pair) / c_word[s.h]), np.log10(p_word[s.w]))
            backs_off = ~seen & (c_word[s.h] > 0)
            base = np.log10((c_word + 0.5) / (uni.total + 0.5 * (n_types + 1)))
            n_known = np.add.reduceat((c_word > 0)[s.tokens].astype(np.int64), s.starts)
            base_score = np.add.reduceat(base[s.tokens], s.starts)
            score = np.add.reduceat(log[s.pair_of], s.starts)
            open_tokens = np.flatnonzero(backs_off[s.pair_of])
            doc = np.searchsorted(s.starts, open_tokens, side="right") - 1
            history = s.h[s.pair_of[open_tokens]]
            wanted = np.zeros(len(s.words), dtype=bool)
            wanted[history] = True
            number = np.cumsum(wanted) - 1  # of a wanted history
            docs = [
                {"doc_id": d, "held_out": not t, "n_tokens": int(n), "n_known": int(k), "base_score": float(b), "score": float(x)}
                for d, t, n, k, b, x in zip(s.doc_ids, s.train, s.sizes, n_known, base_score, score, strict=True)
            ]
            out.append((row["segment"], None, docs, _pack(np.stack([doc, number[history]]).astype(np.int32)), int(wanted.sum()), *[None] * 6))
            order, cut = _dealt(s.words, shards)
            place = np.where(wanted, number, -1)[order]
            g, q = given[order], wanted[order]
            for k in range(shards):
                a, b = cut[k : k + 2]
                o, gg, qq = order[a:b], g[a:b], q[a:b]
                if gg.any() or qq.any():
                    o_given, o_asked = o[gg], o[qq]
                    out.append((row["segment"], k, None, None, None, s.words[o_given].tobytes(), _pack(lost[o_given]), _pack(mass[o_given]), _pack(c_word[o_given]), s.words[o_asked].tobytes(), _pack(place[a:b][qq].astype(np.int32))))
        doc_kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]))
        names = ["segment", "shard", "docs", "open", "n_wanted", "given", "lost", "mass", "count", "asked", "place"]
        return pa.Table.from_batches([_batch(out, names, [pa.int64(), pa.int32(), doc_kind, pa.binary(), pa.int32(), *[pa.binary()] * 6])])

    return run


SCORED = (
    "segment long, shard int, docs array<struct<doc_id: long, held_out: boolean, n_tokens: long, n_known: long, base_score: double, score: double>>, "
    "open binary, n_wanted int, given binary, lost binary, mass binary, count binary, asked binary, place binary"
)


def backoff_weights(words: np.ndarray, lost: np.ndarray, mass: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct histories and alpha of each, from parts: (lost / count) / (1 - unigram mass of the followers)."""
    types, first, at = np.unique(words, return_index=True, return_inverse=True)
    left = np.bincount(at, weights=lost) / np.maximum(count[first], 1)
    return types, left / np.maximum(1 - np.bincount(at, weights=mass), 1e-12)


def _alphas(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    given = np.concatenate([np.frombuffer(r["given"], dtype=np.uint64) for r in rows])
    whole = lambda c, kind: np.concatenate([_unpack(r[c], kind) for r in rows])
    types, alpha = backoff_weights(given, whole("lost", float), whole("mass", float), whole("count", np.int64))
    out = []
    for r in rows:
        asked = np.frombuffer(r["asked"], dtype=np.uint64)
        if len(asked):
            out.append((r["segment"], r["place"], np.log10(alpha[np.searchsorted(types, asked)]).tobytes()))
    return pa.Table.from_batches([_batch(out, ["segment", "place", "alpha"], [pa.int64(), pa.binary(), pa.binary()])])


def _finish(left: pa.Table, right: pa.Table) -> pa.Table:
    """Adds log alpha of the tokens that back off to their documents' scores."""
    docs = []
    for row in left.to_pylist():
        log = np.zeros(row["n_wanted"])
        for r in right.to_pylist():
            log[_unpack(r["place"], np.int32)] = np.frombuffer(r["alpha"], dtype=float)
        doc, number = _unpack(row["open"], np.int32).reshape(2, -1)
        add = np.bincount(doc, weights=log[number], minlength=len(row["docs"]))
        docs += [d | {"score": d["score"] + float(a)} for d, a in zip(row["docs"], add, strict=True)]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
    return pa.Table.from_batches([_batch([tuple(d[c] for c in names) for d in docs], names, kinds)])


def score_documents(docs: DataFrame, held_out: F.Column | None = None) -> DataFrame:
    """Score all rows of ``docs`` (doc_id, text) by a model of those that are not held out.

    ``held_out`` defaults to crc32(doc_id) mod 5 = 1. Returns per row: doc_id,
    held_out, n_tokens (words and the end), n_known (tokens met in training),
    train_tokens, base_score (add-half unigrams) and score, both log10. A null or
    empty text is the end alone. A null doc_id is not held out. Equal rows are
    scored (and learned from) each by itself. Other columns are not read.
    """
    if held_out is None:
        held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~F.coalesce(held_out, F.lit(False))).alias("train"), "text")
    segments = store(map_arrow(rows, _tokenise, DOCS), "segments")
    size = F.aggregate(F.transform("sizes", lambda x: x.cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)
    shards = max(1, math.ceil((segments.agg(F.sum(size)).first()[0] or 0) / SHARD_TOKENS))
    asked = map_arrow(segments, _ask(shards), "segment long, shard int, words binary, marks binary, pairs binary, own binary")
    answers = store(
        asked.groupBy("shard").applyInArrow(
            _count, "segment long, shard int, words binary, pairs binary, word_spectrum array<long>, pair_spectrum array<long>"
        ),
        "counts",
    )
    places = range(CUTOFF + 3)
    sums = answers.where("segment is null").agg(*[F.sum(F.col(c)[k]).alias(f"{c}{k}") for c in ("word_spectrum", "pair_spectrum") for k in places]).first()
    word_spectrum, pair_spectrum = ([sums[f"{c}{k}"] or 0 for k in places] for c in ("word_spectrum", "pair_spectrum"))
    uni, bi = Discount.of(word_spectrum), Discount.of(pair_spectrum)
    replies = answers.where("segment is not null").select("segment", "shard", "words", "pairs")
    scored = store(
        segments.groupBy("segment").cogroup(replies.groupBy("segment")).applyInArrow(_score(shards, uni, bi, word_spectrum[-2]), SCORED), "scored"
    )
    weights = scored.where("shard is not null").select("segment", "shard", "given", "lost", "mass", "count", "asked", "place")
    alphas = weights.groupBy("shard").applyInArrow(_alphas, "segment long, place binary, alpha binary")
    pending = scored.where("shard is null").select("segment", "docs", "open", "n_wanted")
    done = pending.groupBy("segment").cogroup(alphas.groupBy("segment")).applyInArrow(
        _finish, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    train_tokens = F.lit(uni.total).cast("long").alias("train_tokens")
    return done.select("doc_id", "held_out", "n_tokens", "n_known", train_tokens, "base_score", "score")

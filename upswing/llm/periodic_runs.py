"""Periodic run detection by multi-scale minimizers (operator 12).

A run is a stretch of words that repeats with smallest period q, is at least
``max(MIN_LENGTH, TIMES * q)`` long and cannot be extended. A lag scan (words equal
to the word ``lag`` places on) finds the runs of each period up to ``DIRECT``.
Longer periods are found by scale: at scale P, for periods from P to 2P - 1, the
smallest hash of P/2 successive grams of P/2 words is marked. Windows a period
apart inside a run are equal, so marks repeat at the distance of the period. Marks
of one gram closer than P/4 form a group (there the gram overlaps itself) whose
first mark stands for it; each first mark is paired with those of its gram at
distances P to 2P - 1, at most seven. A pair's distance is a period if the words
on one side of it repeat, which prefix hashes tell; then the stretch is extended
word by word.

Why no run is lost: what makes a mark the first of its group lies within 7P/4
words, a run of period q >= P is at least 4q long, and a group is shorter than
q + P/4 (else a shorter period would hold for the whole run); so a first mark and
the same one a period on both lie inside every run.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswing.llm.common import binary_texts, map_arrow, mix64

MIN_LENGTH, TIMES = 6, 4
DIRECT = 15  # periods up to here are scanned directly; the first scale begins above
ROWS = 200  # of a batch are searched together
ODD = 0x9E3779B97F4A7C15
RUN = "struct<start: long, length: long, period: long>"


def _stretches(equal: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """[start, end) of each maximal stretch of True that is ``least`` long."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], equal.view(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    for k in np.flatnonzero(ends - starts >= least):
        yield int(starts[k]), int(ends[k])


class _Hashes:
    """Hashes (modulo 2**64) of any stretch of words, from prefix sums of word hash times power."""

    def __init__(self, ids: np.ndarray):
        self.power, self.prefix = np.ones(len(ids) + 1, dtype=np.uint64), np.zeros(len(ids) + 1, dtype=np.uint64)
        np.cumprod(np.full(len(ids), ODD, dtype=np.uint64), out=self.power[1:])
        np.cumsum(mix64(ids.astype(np.uint64) + np.uint64(ODD)) * self.power[:-1], out=self.prefix[1:])

    def grams(self, size: int) -> np.ndarray:
        """The hash of every stretch of ``size`` words."""
        n = len(self.prefix) - size
        return mix64((self.prefix[size:] - self.prefix[:n]) * self.power[::-1][size - 1 : size - 1 + n])

    def repeats(self, at: np.ndarray, lag: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the ``size`` words from ``at`` equal those ``lag`` later (never False where they do)."""
        n = len(self.prefix) - 1
        inside = (at >= 0) & (at + lag + size <= n)
        a, lag, size = (np.where(inside, x, 0) for x in (at, lag, size))
        here = (self.prefix[a + size] - self.prefix[a]) * self.power[lag]
        return inside & (here == self.prefix[a + lag + size] - self.prefix[a + lag])


def _marks(grams: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest (leftmost of equal) gram of each ``window`` successive ones."""
    n, least, reach = len(grams), grams, 1
    order = np.arange(n)
    # by doubling: the smallest of twice as many, then of exactly ``window``
    while reach < window:
        step = min(reach, window - reach)
        right = order[step:]
        order = np.where(least[right] < least[order[: len(right)]], right, order[: len(right)])
        reach += step
    return np.unique(order)


def _pairs(ids: np.ndarray, hashes: _Hashes, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of equal first marks at distances ``scale`` to ``2 * scale - 1`` that pass the hash test."""
    none = np.zeros(0, dtype=np.int64)
    size = scale // 2
    if len(ids) < TIMES * scale:
        return none, none
    grams = hashes.grams(size)
    marks = _marks(grams, size)
    of = grams[marks]
    order = np.lexsort((marks, of))
    marks, of = marks[order], of[order]
    near = np.concatenate([[False], (of[1:] == of[:-1]) & (marks[1:] - marks[:-1] < scale // 4)])
    marks, of = marks[~near], of[~near]
    places, lags = [], []
    for k in range(1, 9):  # first marks of a gram are at least scale / 4 apart
        far = marks[k:] - marks[:-k]
        fits = (of[k:] == of[:-k]) & (far >= scale) & (far < 2 * scale)
        places.append(marks[:-k][fits])
        lags.append(far[fits])
    at, lag = np.concatenate(places), np.concatenate(lags)
    good = hashes.repeats(at, lag, lag) | hashes.repeats(at - lag + 1, lag, lag)
    return at[good], lag[good]


def _extend(ids: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The stretch [start, end) around ``at`` whose words equal those ``lag`` later (empty if not at ``at``)."""
    end, step = at, 64
    while end < len(ids) - lag:
        here = ids[end : min(end + step, len(ids) - lag)]
        equal = here == ids[end + lag : end + lag + len(here)]
        if not equal.all():
            end += int(np.argmin(equal))
            break
        end, step = end + len(here), 2 * step
    start, step = at, 64
    while start > 0:
        low = max(0, start - step)
        equal = ids[low:start] == ids[low + lag : start + lag]
        if not equal.all():
            start -= int(np.argmin(equal[::-1]))
            break
        start, step = low, 2 * step
    return start, end


def _sequence(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All ids with a number of its own after each document, and where each document starts.

    What repeats at some lag for longer than the lag holds no such number, so it lies inside one document.
    """
    out = np.full(sum(len(d) + 1 for d in docs), -1, dtype=np.int64)
    ends = np.cumsum([len(d) + 1 for d in docs]) - 1
    out[ends] = -1 - np.arange(len(docs))
    starts = np.concatenate([[0], ends[:-1] + 1])
    for d, at in zip(docs, starts.tolist(), strict=True):
        out[at : at + len(d)] = d
    return out, starts


def _long_periods(ids: np.ndarray, scale: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, lag) of the stretches that the pairs of a scale seed."""
    at, lag = _pairs(ids, _Hashes(ids), scale)
    order = np.lexsort((at, lag))
    done_lag, done = -1, -1
    for place, distance in zip(at[order].tolist(), lag[order].tolist(), strict=True):
        if distance == done_lag and place < done:
            continue  # in the stretch just found
        start, end = _extend(ids, place, distance)
        if end > start:
            done_lag, done = distance, end
            if end - start >= (TIMES - 1) * distance:
                yield start, end, distance


def runs_of(docs: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each sequence of ids, by start, then period."""
    found: list[dict[tuple[int, int], int]] = [{} for _ in docs]

    def add(members: list[int], starts: np.ndarray, stretches: Iterator[tuple[int, int, int]]) -> None:
        for start, end, lag in stretches:
            k = int(np.searchsorted(starts, start, side="right")) - 1
            place = start - int(starts[k]), end + lag - start
            if place[1] >= MIN_LENGTH:  # a multiple of the period has the same stretch
                mine = found[members[k]]
                mine[place] = min(lag, mine.get(place, lag))

    members = [k for k, d in enumerate(docs) if len(d) >= MIN_LENGTH]
    if members:
        ids, starts = _sequence([docs[k] for k in members])
        for lag in range(1, DIRECT + 1):
            add(members, starts, ((a, b, lag) for a, b in _stretches(ids[:-lag] == ids[lag:], (TIMES - 1) * lag)))
    scale = DIRECT + 1
    while members := [k for k in members if len(docs[k]) >= TIMES * scale]:
        ids, starts = _sequence([docs[k] for k in members])
        add(members, starts, _long_periods(ids, scale))
        scale *= 2
    return [sorted((start, length, period) for (start, length), period in f.items()) for f in found]


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each of ``n`` words stays: no run holds it after its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def longest_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period, exactly; of equals the first, then that of the smallest period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def tiled(words: list[bytes], g: int) -> list[bytes]:
    """From word g mod n on, the words repeat with a period that leaves three to ten repeats of what follows."""
    n = len(words)
    if not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            piece = batch.slice(first, ROWS)
            docs = [t.split() if t else [] for t in binary_texts(piece.column("text"))]
            docs = [w if g is None else tiled(w, g) for w, g in zip(docs, piece.column("tiling").to_pylist(), strict=True)]
            numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
            all_runs = runs_of([np.fromiter(map(numbers.__getitem__, w), dtype=np.int64, count=len(w)) for w in docs])
            texts = []
            for words, runs in zip(docs, all_runs, strict=True):
                if runs:
                    words = [words[k] for k in np.flatnonzero(kept_words(len(words), runs)).tolist()]
                texts.append(b" ".join(words))
            best = [longest_run(r) for r in all_runs]
            named = lambda r: r and dict(zip(("start", "length", "period"), r, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array([[named(r) for r in rs] for rs in all_runs], pa.list_(run)),
                    pa.array([named(r) for r in best], run),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "runs", "longest", "collapsed"],
            )


def periodic_runs(docs: DataFrame, tiling: F.Column | None = None) -> DataFrame:
    """All runs of the words of every whole text of ``docs`` (doc_id, text): doc_id, runs, longest, collapsed.

    Words are separated by ASCII white space. ``runs`` (start, length, period; by
    start, then period) are exact; ``longest`` is that of greatest length / period
    (null without a run); ``collapsed`` holds the words outside all runs and the
    first period of each, joined by single spaces. ``tiling`` (long) rewrites a
    document's words before (see ``tiled``) where it is not null. A null or empty
    text has no words, no runs and an empty ``collapsed``; a document of any length
    is searched whole, by one task; a null doc_id is kept; equal rows are searched
    each; other columns are read only by ``tiling``. An empty table gives an empty
    one.
    """
    tiling = F.lit(None) if tiling is None else tiling
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", tiling.cast("long").alias("tiling"))
    return map_arrow(rows, _find, f"doc_id long, runs array<{RUN}>, longest {RUN}, collapsed string")


def run_digests(found: DataFrame) -> DataFrame:
    """Of each row of ``periodic_runs``: doc_id, n_runs, the longest run with exponent_milli, runs_sha256, collapsed_sha256."""
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    best = F.col("longest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("(1000 * longest.length) div longest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

"""Language identification by a bidirectional gated recurrent network over bytes (operator 7).

The network reads the UTF-8 bytes of a text in both directions, labels every
byte position with a distribution over the learned languages, and a document's
distribution is the mean over all its positions. It is trained in numpy by
backpropagation through time. Texts are read whole, in runs of ``SPAN`` bytes
that go through the network side by side; the state starts anew at each run.
Gates are piecewise linear, clip(x / 4 + 1/2, 0, 1), and the candidate is
x / (1 + |x|): in numpy these cost a fraction of exp and tanh.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswing.llm.common import binary_texts, map_arrow, unit_hash

SPAN = 128  # bytes a run
HIDDEN = 8  # units each direction
SAMPLE_DOCS = 600  # training documents per language (expected), the bound of the training sample
SAMPLE_RUNS = 4  # runs of TRAIN_SPAN bytes from each of them
TRAIN_SPAN = 64
STEPS, BATCH, RATE = 250, 192, 0.02
BROADCAST_LANGUAGES = 10_000  # rows up to which the counts by language are broadcast
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Network:
    """Weights by direction (first axis: forward, backward); gate order update, reset, candidate."""

    languages: list[str]
    embed: np.ndarray  # (2, 3H, 256): input projection of each byte, with the gates' biases
    recur: np.ndarray  # (2, 3H, H)
    bias: np.ndarray  # (2, H, 1): bias of the candidate's recurrent part
    out: np.ndarray  # (2, L, H)
    out_bias: np.ndarray  # (L, 1)

    PARTS = ("embed", "recur", "bias", "out", "out_bias")

    @classmethod
    def fresh(cls, languages: list[str], hidden: int = HIDDEN, seed: int = 5) -> Network:
        rng, n = np.random.default_rng(seed), len(languages)
        draw = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
        return cls(
            languages,
            draw(0.3, 2, 3 * hidden, 256),
            draw(hidden**-0.5, 2, 3 * hidden, hidden),
            np.zeros((2, hidden, 1), np.float32),
            draw(hidden**-0.5, 2, n, hidden),
            np.zeros((n, 1), np.float32),
        )


def _gate(x: np.ndarray) -> np.ndarray:
    return np.clip(0.25 * x + 0.5, 0, 1)


def _slope(gate: np.ndarray) -> np.ndarray:
    return 0.25 * ((gate > 0) & (gate < 1))


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=0))
    return e / e.sum(axis=0)


def loss_and_gradients(net: Network, x: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Weighted mean cross-entropy over all positions of full runs ``x`` (T, B), and its gradients."""
    steps, batch = x.shape
    hid = net.bias.shape[1]
    both = np.stack([x, x[::-1]])  # the backward direction reads from the end
    h = np.zeros((2, hid, batch), net.embed.dtype)
    past, gates = [], []
    for t in range(steps):
        pre = np.stack([net.embed[d][:, both[d, t]] for d in (0, 1)])
        rec = net.recur @ h
        z = _gate(pre[:, :hid] + rec[:, :hid])
        r = _gate(pre[:, hid : 2 * hid] + rec[:, hid : 2 * hid])
        inner = rec[:, 2 * hid :] + net.bias
        n = pre[:, 2 * hid :] + r * inner
        n = n / (1 + np.abs(n))
        past.append(h)
        gates.append((z, r, n, inner))
        h = n + z * (h - n)
    states = [*past[1:], h]  # after each step
    grads = {k: np.zeros_like(getattr(net, k)) for k in Network.PARTS}
    share = (weights / (weights.sum() * steps)).astype(net.embed.dtype)
    onehot = np.eye(len(net.languages), dtype=net.embed.dtype)[:, labels]
    loss, from_out = 0.0, [np.zeros_like(h) for _ in range(steps)]
    for t in range(steps):
        f, b = states[t][0], states[steps - 1 - t][1]
        p = _softmax(net.out[0] @ f + net.out[1] @ b + net.out_bias)
        loss -= float((share * np.log(np.maximum((p * onehot).sum(axis=0), 1e-12))).sum())
        d = (p - onehot) * share
        grads["out"][0] += d @ f.T
        grads["out"][1] += d @ b.T
        grads["out_bias"] += d.sum(axis=1, keepdims=True)
        from_out[t][0] += net.out[0].T @ d
        from_out[steps - 1 - t][1] += net.out[1].T @ d
    back = np.zeros_like(h)
    for t in reversed(range(steps)):
        (z, r, n, inner), before = gates[t], past[t]
        back = back + from_out[t]
        dn = back * (1 - z) * (1 - np.abs(n)) ** 2
        dz = back * (before - n) * _slope(z)
        dinner = dn * r
        dr = dn * inner * _slope(r)
        drec = np.concatenate([dz, dr, dinner], axis=1)
        dpre = np.concatenate([dz, dr, dn], axis=1)
        grads["recur"] += drec @ before.transpose(0, 2, 1)
        grads["bias"] += dinner.sum(axis=2, keepdims=True)
        for d in (0, 1):
            seen = np.zeros((256, batch), net.embed.dtype)
            seen[both[d, t], np.arange(batch)] = 1
            grads["embed"][d] += dpre[d] @ seen.T
        back = back * z + net.recur.transpose(0, 2, 1) @ drec
    return loss, grads


def train(runs: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = STEPS, seed: int = 5) -> Network:
    """Adam on random batches of full runs (N, T); languages weigh the same whatever their shares."""
    net, rng = Network.fresh(languages, seed=seed), np.random.default_rng(seed)
    counts = np.bincount(labels, minlength=len(languages))
    weight = (len(labels) / np.maximum(counts, 1)).astype(np.float32)
    mean = {k: np.zeros_like(getattr(net, k)) for k in Network.PARTS}
    var = {k: np.zeros_like(getattr(net, k)) for k in Network.PARTS}
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(runs), BATCH)
        _, grads = loss_and_gradients(net, runs[pick].T, labels[pick], weight[labels[pick]])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            g *= min(1.0, 1.0 / max(norm, 1e-9))
            mean[k] += 0.1 * (g - mean[k])
            var[k] += 0.01 * (g * g - var[k])
            getattr(net, k)[...] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(var[k] / (1 - 0.99**step)) + 1e-8)
    return net


class Labeller:
    """Applies a network to many runs at once: the sums over each run's positions of the language probabilities."""

    def __init__(self, net: Network):
        hid = net.bias.shape[1]
        scale = np.ones((3 * hid, 1), np.float32)
        scale[: 2 * hid] = 0.25
        embed = net.embed * scale
        embed[:, : 2 * hid] += 0.5  # the gates are then a mere clip
        split = lambda m: [[np.ascontiguousarray(m[d, k * hid : (k + 1) * hid].T) for k in range(3)] for d in (0, 1)]
        self.hid, self.embed, self.recur = hid, split(embed), split(net.recur * scale)
        self.bias = [np.ascontiguousarray(net.bias[d].T) for d in (0, 1)]
        self.out, self.out_bias = net.out, net.out_bias

    def states(self, x: np.ndarray, inside: np.ndarray | None, direction: int) -> np.ndarray:
        """(T, B, H) states of one direction over ``x`` (T, B); ``inside`` marks positions that are not padding."""
        steps, batch = x.shape
        (ez, er, en), (uz, ur, un), bias = self.embed[direction], self.recur[direction], self.bias[direction]
        out = np.empty((steps, batch, self.hid), np.float32)
        h = np.zeros((batch, self.hid), np.float32)
        z, r, n, rec = (np.empty_like(h) for _ in range(4))
        for t in range(steps) if direction == 0 else reversed(range(steps)):
            for gate, e, u in ((z, ez, uz), (r, er, ur)):
                np.take(e, x[t], axis=0, out=gate, mode="clip")
                np.matmul(h, u, out=rec)
                gate += rec
                np.clip(gate, 0, 1, out=gate)
            np.matmul(h, un, out=rec)
            rec += bias
            rec *= r
            np.take(en, x[t], axis=0, out=n, mode="clip")
            n += rec
            np.abs(n, out=r)
            r += 1
            n /= r
            np.subtract(h, n, out=rec)
            rec *= z
            h = out[t]
            np.add(n, rec, out=h)
            if inside is not None and direction:
                h *= inside[t][:, None]  # the padding comes first for this direction
        return out

    def sums(self, x: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
        """(L, B) sums of the position probabilities of runs ``x`` (T, B)."""
        steps = len(x)
        x = x.astype(np.intp)
        inside = None if lengths is None else (np.arange(steps)[:, None] < lengths[None, :]).astype(np.float32)
        f, b = self.states(x, inside, 0), self.states(x, inside, 1)
        total = np.zeros((len(self.out_bias), x.shape[1]), np.float32)
        for t in range(steps):
            p = self.out[0] @ f[t].T
            p += self.out[1] @ b[t].T
            p += self.out_bias
            np.exp(p, out=p)  # states are within (-1, 1), so the sums stay far from overflow
            p /= p.sum(axis=0)
            if inside is not None:
                p *= inside[t]
            total += p
        return total

    def documents(self, texts: list[bytes], block: int = 2048) -> np.ndarray:
        """(N, L) mean probabilities of each non-empty text."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        data = np.frombuffer(b"".join(texts) + b"\0" * SPAN, dtype=np.uint8)
        runs = -(-sizes // SPAN)
        doc = np.repeat(np.arange(len(texts)), runs)
        within = np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs)
        start = (np.cumsum(sizes) - sizes)[doc] + within * SPAN
        length = np.minimum(sizes[doc] - within * SPAN, SPAN)
        order = np.argsort(-length, kind="stable")  # full runs first; then runs of like lengths together
        total = np.zeros((len(texts), len(self.out_bias)))
        for at in range(0, len(order), block):
            take = order[at : at + block]
            lens = length[take]
            x = data[start[take][None, :] + np.arange(int(lens[0]))[:, None]]
            sums = self.sums(x, None if lens[-1] == lens[0] else lens)
            for k in range(len(sums)):
                total[:, k] += np.bincount(doc[take], weights=sums[k], minlength=len(texts))
        return total / sizes[:, None]


def training_runs(docs: DataFrame, seed: int = 11) -> DataFrame:
    """The bounded training sample of (doc_id, text, lang): (lang, run), runs of whole text pieces.

    About ``SAMPLE_DOCS`` documents of each language, drawn by a fixed hash, give
    ``SAMPLE_RUNS`` pieces each; a top-k over that hash makes the bound a hard one.
    """
    rows = docs.where("lang is not null and length(text) > 0").withColumn("u", unit_hash("doc_id", "text", F.lit(seed)))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    n_langs = counts.count()
    if n_langs <= BROADCAST_LANGUAGES:  # else the texts would be shuffled by language
        counts = F.broadcast(counts)
    drawn = rows.join(counts, "lang").where(F.col("u") * F.col("n") < SAMPLE_DOCS)
    drawn = drawn.orderBy("u", "doc_id").limit(2 * SAMPLE_DOCS * max(1, n_langs))
    place = lambda k: (F.pmod(F.xxhash64("doc_id", F.lit(seed + k)), F.greatest(F.lit(1), F.length("text") - TRAIN_SPAN)) + 1).cast("int")
    pieces = F.array(*[F.col("text").substr(place(k), F.lit(TRAIN_SPAN)) for k in range(SAMPLE_RUNS)])
    return drawn.select("doc_id", "lang", F.explode(pieces).alias("run"))


def fit(docs: DataFrame, steps: int = STEPS) -> Network | None:
    """Train on the sample of ``docs``; None if no row has both a text and a language."""
    sample = sorted((r["lang"], r["run"]) for r in training_runs(docs).select("lang", "run").collect())
    if not sample:
        return None
    languages = sorted({lang for lang, _ in sample})
    full = [(languages.index(lang), (run.encode() * TRAIN_SPAN)[:TRAIN_SPAN]) for lang, run in sample if run]
    runs = np.frombuffer(b"".join(r for _, r in full), dtype=np.uint8).reshape(len(full), TRAIN_SPAN)
    return train(runs, np.array([k for k, _ in full]), languages, steps)


def _predict(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(net) if net else None
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                texts = list(binary_texts(batch.column("text")))
                lang, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
                known = [i for i, t in enumerate(texts) if t and labeller and _LETTER.search(t.decode(errors="replace"))]
                if known:
                    p = labeller.documents([texts[i] for i in known])
                    for i, k, s in zip(known, p.argmax(axis=1), p.max(axis=1), strict=True):
                        lang[i], score[i] = net.languages[k], float(min(1.0, s))
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(lang), pa.array(score)], names=["row", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, net: Network | None, columns: list[str] | None = None) -> DataFrame:
    """(row, lang_pred, score) for each row of ``docs``; row is a struct of its ``columns`` (default: all).

    ``und`` with score 0 where the text is null, has no letter, or nothing was
    learned. The prediction reads only the text.
    """
    rows = docs.select(F.struct(*(columns or docs.columns)).alias("row"), "text")
    kind = rows.schema["row"].dataType.simpleString()
    return map_arrow(rows, _predict(net), f"row {kind}, lang_pred string, score double")


def held_out_rows() -> F.Column:
    """crc32(doc_id as text) mod 4 = 2; a null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, held_out: F.Column | None = None) -> DataFrame:
    """Learn from the rows of ``docs`` (doc_id, text, lang) that are not held out and label all of them.

    ``held_out`` defaults to ``held_out_rows()``. Returns doc_id, held_out,
    lang_pred, score, a row for each row. Rows
    without a language are labelled but not learned from. Other columns are not
    read.
    """
    rows = docs.select("doc_id", "text", "lang")
    held_out = held_out_rows() if held_out is None else F.coalesce(held_out, F.lit(False))
    net = fit(rows.where(~held_out))
    labelled = predict(rows.select("doc_id", held_out.alias("held_out"), "text"), net, ["doc_id", "held_out"])
    return labelled.select("row.doc_id", "row.held_out", "lang_pred", "score")

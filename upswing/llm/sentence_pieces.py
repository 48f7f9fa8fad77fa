"""SentencePiece encoding with byte spans, and decoding (operator 13).

A text is normalised by the model's compiled character map: at each position the
longest rule that fits is replaced, anything else is kept, and every normalised
byte remembers where its source began. The normalised text is cut before each run
of spaces where no piece of the vocabulary crosses such a cut; merges on one side
cannot touch the other, so each distinct segment is segmented once per worker (by
the sentencepiece library, told not to normalise again). A piece covers a stretch
of normalised bytes, and the alignment projects it to the bytes of the original.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswing.llm.common import binary_texts, map_arrow

SPACE = "▁".encode()  # what stands for a space in pieces
ENCODED = "doc_id long, ids array<int>, begins array<int>, ends array<int>"
ROWS = 200  # of a batch are encoded together

# Fixed values of the model format: field numbers and kinds of pieces.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
CHAR_MAP, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE = 2, 3, 4, 5
BYTE_FALLBACK, SPACE_SUFFIX, BEGIN_ID, END_ID = 35, 24, 41, 42
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        shift, at = shift + 7, at + 1
        if data[at - 1] < 128:
            return value, at


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a serialised message."""
    at = 0
    while at < len(message):
        tag, at = _varint(message, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(message, at)
        else:
            size, at = _varint(message, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = message[at : at + size], at + size
        yield tag >> 3, value


def _field(number: int, value: int | bytes) -> bytes:
    def varint(n: int) -> bytes:
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


class CharMap:
    """Replacement rules compiled to a double-array trie whose leaves point at NUL-ended replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], dtype="<u4").tolist()
        self.values = blob[4 + size :]
        self.first = bytes(b for b in range(256) if self.units and self._step(self._children(0), b) is not None)

    def _children(self, node: int) -> int:
        unit = self.units[node]
        return node ^ (unit >> 10 << (8 if unit & 512 else 0))

    def _step(self, base: int, byte: int) -> int | None:
        node = base ^ byte
        return node if node < len(self.units) and self.units[node] & 0x800000FF == byte else None

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest rule that fits ``text`` at ``at``."""
        if not self.units:
            return None
        found, base = None, self._children(0)
        for k in range(at, len(text)):
            node = self._step(base, text[k])
            if node is None:
                break
            base = self._children(node)
            if self.units[node] & 256:
                found = k + 1 - at, self.units[base] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.values[found[1] : self.values.index(b"\0", found[1])]


class Normaliser:
    """Normalised text with one byte for each space, and where each byte's source begins."""

    def __init__(self, spec: dict[int, int | bytes]):
        self.map = CharMap(spec.get(CHAR_MAP, b""))
        self.prefix, self.trim = bool(spec.get(DUMMY_PREFIX, 1)), bool(spec.get(EXTRA_SPACES, 1))
        if not spec.get(ESCAPE, 1):
            raise ValueError("models whose pieces hold plain spaces are not supported")
        starts = self.map.first.replace(SPACE[:1], b"")
        rule = b"[" + re.escape(starts) + b"]|" if starts else b""
        self.stop = re.compile(rule + (SPACE[:1] if SPACE[0] in self.map.first else SPACE), re.DOTALL)

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The bytes, and the source offset of each and of the end."""
        if not text:
            return b"", np.zeros(1, dtype=np.int64)
        out, at = text, np.arange(len(text))
        raw = np.frombuffer(text, dtype=np.uint8)
        starts = np.maximum.accumulate(np.where((raw & 0xC0) != 0x80, at, 0))  # of the character that a byte belongs to
        source, end = starts, len(text)
        symbols = np.zeros(0, dtype=np.int64)  # where a written space symbol became one byte
        if self.stop.search(text):
            out, source, symbols = self._replace(text, starts)
        if self.trim:
            raw = np.frombuffer(out, dtype=np.uint8)
            space = raw == 32
            space[symbols] = False
            keep = ~(space & np.concatenate([[True], space[:-1]]))
            out, source = raw[keep].tobytes(), source[keep]
            size = len(out.rstrip(b" "))  # written symbols at the end go too
            if not size:
                return b"", np.zeros(1, dtype=np.int64)
            end = int(source[size]) if size < len(out) else end
            out, source = out[:size], source[:size]
        if self.prefix:
            out, source = b" " + out, np.concatenate([source[:1] if self.trim else [0], source])
        return out, np.concatenate([source, [end]])

    def _replace(self, text: bytes, starts: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        parts, sources, symbols, done, size = [], [], [], 0, 0

        def put(part: bytes, source: np.ndarray) -> None:
            nonlocal size
            parts.append(part)
            sources.append(source)
            size += len(part)

        at = 0
        while stop := self.stop.search(text, at):
            at = stop.start()
            if starts[at] != at:
                at += 1
                continue
            found = self.map.longest(text, at)
            if found is None and text.startswith(SPACE, at):
                found = len(SPACE), b" "
                symbols.append(size + at - done)
            if found is None:
                at += 1
                continue
            put(text[done:at], starts[done:at])
            put(found[1], np.full(len(found[1]), at))
            done = at = at + found[0]
        put(text[done:], starts[done:])
        return b"".join(parts), np.concatenate(sources), np.array(symbols, dtype=np.int64)


class PieceEncoder:
    """Ids and source spans of texts; each distinct segment is segmented once."""

    def __init__(self, path: str, most: int = 1_000_000):
        from sentencepiece import SentencePieceProcessor

        with open(path, "rb") as f:
            model = f.read()
        parts = list(fields(model))
        pieces = [dict(fields(v)) for n, v in parts if n == PIECES]
        trainer = next((dict(fields(v)) for n, v in parts if n == TRAINER), {})
        spec = next((dict(fields(v)) for n, v in parts if n == NORMALIZER), {})
        if trainer.get(SPACE_SUFFIX):
            raise ValueError("models that write spaces after words are not supported")
        self.normalise = Normaliser(spec)
        self.begin, self.end = trainer.get(BEGIN_ID, 1), trainer.get(END_ID, 2)
        plain = _field(CHAR_MAP, b"") + b"".join(_field(n, 0) for n in (DUMMY_PREFIX, EXTRA_SPACES, ESCAPE))
        kept = [_field(n, plain if n == NORMALIZER else v) for n, v in parts if n <= NORMALIZER]
        self.segmenter = SentencePieceProcessor(model_proto=b"".join(kept))
        self.decoder = SentencePieceProcessor(model_proto=model)
        texts = [(p[1].replace(SPACE, b" "), p.get(3, NORMAL)) for p in pieces]
        self.sizes = np.array([1 if kind == BYTE else len(t) for t, kind in texts], dtype=np.int64)
        self.fallback = bool(trainer.get(BYTE_FALLBACK))
        crossing = any(kind != CONTROL and re.search(b"[^ ] ", t) for t, kind in texts)
        self.cut = re.compile(b".+" if crossing else b" +[^ ]*|[^ ]+", re.DOTALL)
        self.most = most
        self.reset()

    def reset(self) -> None:
        self.segments: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.first, self.size = array("q"), array("q")  # of each segment: its run in the pools
        self.ids, self.spans = array("i"), array("i")  # ids, and the normalised bytes of each

    def _learn(self) -> None:
        keys = reversed(self.segments)
        new = [next(keys) for _ in range(len(self.segments) - len(self.first))][::-1]
        texts = [s.replace(b" ", SPACE).decode() for s in new]
        for text, ids in zip(texts, self.segmenter.encode(texts, num_threads=1), strict=True):
            self.first.append(len(self.ids))
            self.size.append(len(ids))
            self.ids.extend(ids)
            if self.fallback:
                self.spans.extend(self.sizes[ids].tolist())
            else:  # an unknown piece is as long as its surface
                proto = self.segmenter.encode(text, out_type="immutable_proto")
                self.spans.extend(len(p.surface.encode().replace(SPACE, b" ")) for p in proto.pieces)

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids with begin and end, and the source bytes [begin, end) of each, of every text."""
        if len(self.segments) > self.most:
            self.reset()
        known, aligned = [], []
        for text in texts:
            out, source = self.normalise(text)
            known.append([self.segments[s] for s in self.cut.findall(out)])
            aligned.append(source)
        if len(self.segments) > len(self.first):
            self._learn()
        first, size = (np.frombuffer(x, dtype=np.int64) if x else np.zeros(0, np.int64) for x in (self.first, self.size))
        ids, spans = (np.frombuffer(x, dtype=np.int32) if x else np.zeros(0, np.int32) for x in (self.ids, self.spans))
        result = []
        for numbers, source, text in zip(known, aligned, texts, strict=True):
            at = np.array(numbers, dtype=np.int64)
            ends = np.cumsum(size[at])
            total = int(ends[-1]) if len(at) else 0
            run = np.arange(total) + np.repeat(first[at] - (ends - size[at]), size[at])
            borders = source[np.concatenate([[0], np.cumsum(spans[run])])]
            result.append(
                (
                    np.concatenate([[self.begin], ids[run], [self.end]]).astype(np.int32),
                    np.concatenate([[0], borders[:-1], [len(text)]]).astype(np.int32),
                    np.concatenate([[0], borders[1:], [len(text)]]).astype(np.int32),
                )
            )
        return result


_ENCODERS: dict[str, PieceEncoder] = {}  # kept by a worker between its tasks


def _encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                piece = batch.slice(at, ROWS)
                rows = _encoder(path).encode([t or b"" for t in binary_texts(piece.column("text"))])
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([r[k] for r in rows]))) for k in range(3)]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *lists], names=["doc_id", "ids", "begins", "ends"])

    return run


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """Encode every whole text of ``docs`` (doc_id, text): doc_id, ids, begins, ends.

    ``ids`` are those of the sentencepiece library with begin and end ids; piece k
    covers the UTF-8 bytes [begins[k], ends[k]) of the original text. Begin and
    end cover nothing; where a character is written as bytes, its last byte covers
    it and the others nothing. What normalisation drops belongs to the piece
    before it, as in the library. A null or empty text is begin and end alone; a
    text of any length is encoded whole; a null doc_id is kept; equal rows are
    encoded each; other columns are not read. An empty table gives an empty one.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(rows, _encode(model), ENCODED)


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                piece = batch.slice(at, ROWS)
                texts = _encoder(path).decoder.decode(piece.column("ids").to_pylist(), num_threads=1)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """The texts of ``encoded`` (doc_id, ids) as the library's decode gives them: doc_id, text."""
    return map_arrow(encoded.select("doc_id", "ids"), _decode(model), "doc_id long, text string")


def _digest(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                piece = batch.slice(at, ROWS)
                ids = piece.column("ids")
                flat, cuts = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), ids.offsets.to_numpy()
                own = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                texts = _encoder(path).decoder.decode([x.tolist() for x in own], num_threads=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array([len(x) for x in own], pa.int64()),
                        pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in own]),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]),
                        piece.column("span_bytes"),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "span_bytes"],
                )

    return run


def piece_digests(encoded: DataFrame, model: str) -> DataFrame:
    """Of each row of ``encode_pieces``: doc_id, n_tokens, ids_sha256 (little-endian 32-bit ids), decoded_sha256, span_bytes.

    ``span_bytes`` adds up the bytes that the pieces cover, which is the text's size in bytes.
    """
    covered = F.aggregate(F.zip_with("begins", "ends", lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)
    rows = encoded.select("doc_id", "ids", covered.alias("span_bytes"))
    return map_arrow(rows, _digest(model), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, span_bytes long")

"""Collocations, periodic runs and SentencePiece pieces against brute force and the library."""

import collections
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest
import sentencepiece

from tests.llm.data import DOCS, SF, frame, rows
from upswing.llm import collocations as phrases
from upswing.llm import sentence_pieces as pieces
from upswing.llm.periodic_runs import longest_run, periodic_runs, run_digests, runs_of, tiled
from upswing.llm.queries import QUERIES, tokenizer_path

# ---------------------------------------------------------- collocations ---


def collocations_brute(data, support, top=2000, contained=100):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in data:
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", folded):
            w = [x for x in re.split("[ \t]", piece) if x]
            n[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i : i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= support}
    over = collections.Counter()
    for (lang, p), a in found.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                over[lang, p[i : i + k]] = max(over[lang, p[i : i + k]], a)
    out = collections.defaultdict(list)
    for (lang, p), a in found.items():
        if over[lang, p] and 100 * over[lang, p] >= contained * a:
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, at, p.decode(), -a, left, right, n[lang], -score)
        for lang, x in out.items() for at, (score, a, p, left, right) in enumerate(sorted(x)[:top], 1)
    )


def phrase_rows(seed, docs=80):
    """Texts of few words with planted phrases, so that all lengths become frequent, each lang by itself."""
    rng = random.Random(seed)
    planted = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(4)) for _ in range(k)) for k in (2, 3, 4, 5, 5)]
    out = []
    for i in range(docs):
        words = []
        for _ in range(rng.randrange(60)):
            words.append(rng.choice([*planted, "é", "A", "a", "b,", "x. y", "Zé!", f"w{rng.randrange(40)}"]))
        out.append((i, rng.choice([" ", "\t", "  "]).join(words), rng.choice(["en", "fr", None, "und"]), "s", 0))
    return [*out, *out[:6], (None, "a b a b", "en", None, 0), (900, None, "en", "s", 0), (901, "", None, "s", 0), (902, ".,; !", "fr", "s", 0)]


@pytest.mark.parametrize("seed, support, every, tokens", [(1, 5, 16, 1_000_000), (2, 3, 50, 40), (3, 8, 2, 300)])
def test_collocations(spark, monkeypatch, seed, support, every, tokens):
    """Samples of one document in 2 to 50, so that the border holds from few to nearly all frequent phrases."""
    monkeypatch.setattr(phrases, "LEAST_BITS", 15 if every > 2 else 20)  # and small filters, where many bits are set by chance
    monkeypatch.setattr(phrases, "BITS_EACH", 2 if every > 2 else 16)
    monkeypatch.setattr(phrases, "RANGE_TOKENS", tokens)
    monkeypatch.setattr(phrases, "FLUSH", tokens)
    data = phrase_rows(seed)
    got = phrases.collocations(frame(spark, data, extra=("n", "a", "rank", "phrase", "size", "sampled", "hash")), support, 40, 100, every).collect()
    want = collocations_brute([(r[2], r[1]) for r in data], support, 40)
    assert sorted(tuple(r) for r in got) == want and len(want) > 20


def test_a_sample_that_proposes_nothing_is_made_good(spark):
    data = phrase_rows(4)
    got = phrases.frequent_phrases(frame(spark, data), 4, 10**9)
    assert got.where("size = 5").count() > 0
    all_sampled = phrases.frequent_phrases(frame(spark, data), 4, 1)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, all_sampled.collect()))


def test_collocations_of_large_counts_and_of_contained_phrases(spark):
    """A line in a third of all rows, ties in score, and phrases that only occur inside longer ones."""
    data = [(i, "the very same line\n" + f"u{i}", "en", "s", 0) for i in range(400)] + [(500 + i, f"v{i} p q\np q", "en", "s", 0) for i in range(800)]
    got = [tuple(r) for r in phrases.collocations(frame(spark, data)).collect()]
    assert sorted(got) == collocations_brute([(r[2], r[1]) for r in data], 100)
    assert [r[2] for r in got] == ["the very same line", "p q"]


def test_scores_past_64_bits(spark):
    known = spark.createDataFrame(
        [("en", "", 0, 9 * 10**12), ("en", "a", 1, 4 * 10**12), ("en", "b", 1, 3 * 10**12), ("en", "a b", 2, 2 * 10**12 + 1)], "lang string, phrase string, size int, n long"
    )
    found = phrases.frequent_phrases
    try:
        phrases.frequent_phrases = lambda *_: known
        (row,) = phrases.collocations(spark.createDataFrame([], DOCS)).collect()
    finally:
        phrases.frequent_phrases = found
    assert row["score"] == 1000 * (2 * 10**12 + 1) * 9 * 10**12 // (12 * 10**24)


# --------------------------------------------------------- periodic runs ---


def runs_brute(w):
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = j
    return sorted((a, b, q) for (a, b), q in out.items())


def nested(rng, kinds):
    """Repeats of repeats with odd ends, and now and then a word that breaks them."""
    s = [rng.randrange(kinds) for _ in range(rng.randrange(1, 6))]
    for _ in range(rng.randrange(1, 6)):
        s = s * rng.randrange(1, 7) + [rng.randrange(kinds) for _ in range(rng.randrange(5))] * rng.randrange(2)
    s = [rng.randrange(kinds) for _ in range(rng.randrange(30))] + s[:600]
    if rng.random() < 0.3:
        s[rng.randrange(len(s))] = 99
    return s


def test_runs_of_nested_repeats():
    rng, long = random.Random(9), 0
    for _ in range(150):
        docs = [nested(rng, rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(6))]
        docs = [d for d in docs for _ in range(rng.choice([1, 1, 3]))]
        want = [runs_brute(d) for d in docs]
        assert runs_of([np.array(d, dtype=np.int64) for d in docs]) == want
        long += sum(q > 15 for rs in want for *_, q in rs)
    assert long > 50


@pytest.mark.parametrize("period, times", [(16, 4), (700, 4.01), (5000, 4), (17, 3000), (1, 10_000)])
def test_runs_of_long_periods_and_lengths(period, times):
    rng = np.random.default_rng(period)
    body = np.resize(rng.permutation(period), int(period * times))
    seq = np.concatenate([10**6 + np.arange(50), body, 2 * 10**6 + np.arange(50)])
    assert runs_of([seq]) == [[(50, len(body), period)]]


def digest_brute(i, text, tiling):
    w = [x for x in re.split("[ \t-\r]+", text or "") if x]
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    if tiling and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
    runs = runs_brute(w)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = longest_run(runs)
    return (i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_run_digests(spark):
    data = [r for r in rows() if not r[1] or len(r[1]) < 20_000]
    data += [(i, " ".join(map(str, nested(random.Random(i), 3))), "en", "a", 0) for i in range(200, 260)]
    got = run_digests(periodic_runs(frame(spark, data))).collect()
    assert sorted(map(tuple, got), key=str) == sorted((digest_brute(i, t, False) for i, t, *_ in data), key=str)
    whole = periodic_runs(frame(spark, data, extra=("runs", "longest", "collapsed", "tiling", "words"))).collect()
    assert len(whole) == len(data) and all(len(r["collapsed"].split()) <= len((t or "").split()) for r, (_, t, *_) in zip(sorted(whole, key=lambda r: str(r["doc_id"])), sorted(data, key=lambda r: str(r[0])), strict=True) if t is None or t.isascii())


def test_ties_of_the_longest_run_are_exact():
    assert longest_run([(0, 8, 2), (3, 12, 3), (3, 40, 10)]) == (0, 8, 2)
    assert longest_run([(0, 10**15 + 1, 10**14), (5, 10**15, 10**14)])[0] == 0
    assert longest_run([]) is None


def test_tiling_by_the_documents_number():
    assert tiled([b"a", b"b", b"c", b"d", b"e", b"f"], 7) == [b"a", b"b", b"b", b"b", b"b", b"b"] and tiled([], 3) == []


# ------------------------------------------------------------- pieces ---

MODEL = tokenizer_path("piece_bpe_32k.model")
ODD = list("abc XYZ  \n\t.,é▁日本語😀ß①½ＡＢ　Ǆ각\x00́ͅ가​") + ["▁▁", "<s>", "<0x41>", chr(0x10FFFF)]


def odd_texts(seed, n=1500):
    rng = random.Random(seed)
    out = ["".join(rng.choice(ODD) for _ in range(rng.randrange(40))) for _ in range(n)]
    return [*out, "", " ", "   ", "▁", " ▁ a", "\n", "word " * 3000, "x" * 9000, "日" * 5000]


def library_spans(model, text):
    """(id, begin, end) in bytes, from the library's own message."""
    out = []
    for number, value in pieces.fields(model.encode(text, out_type="serialized_proto")):
        if number == 2:
            piece = dict(pieces.fields(value))
            out.append((piece.get(2, 0), piece.get(4, 0), piece.get(5, 0)))
    return out


def test_ids_and_byte_spans_are_the_librarys():
    model, encoder = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.PieceEncoder(MODEL)
    texts = odd_texts(1)
    for text, (ids, begins, ends) in zip(texts, encoder.encode([t.encode() for t in texts]), strict=True):
        assert ids.tolist() == model.encode(text, add_bos=True, add_eos=True)
        assert list(zip(ids.tolist(), begins.tolist(), ends.tolist(), strict=True))[1:-1] == library_spans(model, text)
        assert int((ends - begins).sum()) == len(text.encode())


@pytest.mark.parametrize("trim", [False, True])
@pytest.mark.parametrize("prefix", [False, True])
@pytest.mark.parametrize("rule", ["nmt_nfkc_cf", "nfkc", "identity"])
def test_normalisation_by_a_compiled_character_map(trim, prefix, rule):
    """The library's built-in maps: same text, and each byte's source is the character that the library names."""
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, escape_whitespaces=True, remove_extra_whitespaces=trim)
    spec = next(dict(pieces.fields(v)) for n, v in pieces.fields(library.serialized_model_proto()) if n == pieces.NORMALIZER)
    own = pieces.Normaliser({**spec, pieces.DUMMY_PREFIX: int(prefix), pieces.EXTRA_SPACES: int(trim), pieces.ESCAPE: 1})
    for text in odd_texts(2, 600)[:-3]:
        want, offsets = library.normalize(text, with_offsets=True)
        got, source = own(text.encode())
        assert got.replace(b" ", pieces.SPACE).decode() == want
        bytes_before = [len(text[:k].encode()) for k in range(len(text) + 1)]
        at = [k for k, b in enumerate(got) if b & 0xC0 != 0x80]
        assert [source[k] for k in at] == [bytes_before[k] for k in offsets[: len(at)]]


def test_segments_are_forgotten_when_there_are_too_many():
    encoder, model = pieces.PieceEncoder(MODEL, most=5), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in ("a b c", "d e f g", "", "a d é 日"):
        assert encoder.encode([text.encode()])[0][0].tolist() == model.encode(text, add_bos=True, add_eos=True)


def test_encoding_and_decoding_on_rows(spark):
    model, data = sentencepiece.SentencePieceProcessor(model_file=MODEL), rows()
    docs = frame(spark, data, extra=("ids", "begins", "ends", "span_bytes", "n_tokens"))
    encoded = pieces.encode_pieces(docs, MODEL)
    texts = collections.Counter((r["doc_id"], r["text"]) for r in pieces.decode_pieces(encoded, MODEL).collect())
    want = [(i, t or "", model.encode(t or "", add_bos=True, add_eos=True)) for i, t, *_ in data]
    assert texts == collections.Counter((i, model.decode(ids)) for i, _, ids in want)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = pieces.piece_digests(encoded, MODEL).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        ((i, len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(model.decode(ids).encode()), len(t.encode())) for i, t, ids in want), key=str
    )


# ---------------------------------------------------------------- tables ---


@pytest.mark.parametrize("run", [
    phrases.collocations,
    lambda d: run_digests(periodic_runs(d)),
    lambda d: pieces.piece_digests(pieces.encode_pieces(d, MODEL), MODEL),
    lambda d: pieces.decode_pieces(pieces.encode_pieces(d, MODEL), MODEL),
])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("name", ["op12_periodic_runs", "op13_sentence_pieces"])
def test_queries_on_a_table(spark, name):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: tuple(r) for r in QUERIES[name](spark, SF).collect()}
    assert len(got) == len(docs)
    for i, text in docs[::3]:
        if name == "op12_periodic_runs":
            assert len(text.split()) > 2000 or got[i] == digest_brute(i, text, True)
        else:
            assert got[i][1] == len(model.encode(text)) + 2 and got[i][4] == len(text.encode())

"""Operators on documents against brute force: near-dedup, decontamination, tokens, mixing, lines."""

import collections
import hashlib
import math
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.data import DOCS, SF, components, frame, rows
from upswing.llm import common, line_dedup, near_dedup, phrase_index, token_store
from upswing.llm.mixing import CYCLE, mix, quality_weights
from upswing.llm.near_dedup import near_duplicates, similar
from upswing.llm.queries import QUERIES, tokenizer_path
from upswing.llm.token_store import ChunkEncoder, read_tokens, token_digests, write_tokens
from upswing.sources.storage import shared_path


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, k):
    w = [x for x in re.split("[ \t-\r]+", fold(text)) if x]
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near_brute(data, k, percent):
    sets = collections.defaultdict(list)
    for i, text in data:
        if i is not None:
            sets[i].append(shingles(text, k))
    links = [
        (a, b)
        for a in sets for b in sets if a < b
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b])
    ]
    comp = components(sets, links)
    return sorted(((i, len(shingles(t, k)), comp.get(i), i is None or comp[i] == i) for i, t in data), key=str)


@pytest.mark.parametrize("block", [200, 3])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    data = [r[:2] for r in rows()]
    got = near_duplicates(frame(spark, rows()), 4, 80).collect()
    assert sorted((tuple(r) for r in got), key=str) == near_brute(data, 4, 80)


def test_near_duplicates_chain_needs_more_than_leaders(spark):
    """Neighbours in the chain are similar, ends are not, and the smallest id sits at one end."""
    base = [f"t{i}" for i in range(60)]
    data = [(i, " ".join(base[: 60 - 2 * i] + [f"c{j}" for j in range(2 * i)]), None, None, None) for i in range(12)]
    got = near_duplicates(frame(spark, data), 4, 80).collect()
    assert sorted((tuple(r) for r in got), key=str) == near_brute([r[:2] for r in data], 4, 80)
    assert len({r["component_id"] for r in got}) < 12


def unlinked_family(n, seed=11):
    """Texts with a common template: they share bands, but few or none are links."""
    rng = random.Random(seed)
    base = [f"t{i}" for i in range(60)]
    return [(i, " ".join(base[:48] + [f"u{rng.randrange(10**6)}" for _ in range(12)]), None, None, None) for i in range(n)]


def test_near_duplicates_of_unlinked_members_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 10)
    data = unlinked_family(80)
    data += [(1000 + k, data[5 * k][1].replace("u", "v", 3), None, None, None) for k in range(10)]
    got = near_duplicates(frame(spark, data), 4, 80).collect()
    assert sorted((tuple(r) for r in got), key=str) == near_brute([r[:2] for r in data], 4, 80)
    assert len(data) > len({r["component_id"] for r in got}) > 70


@pytest.mark.parametrize("m", [1, 40, 120])
def test_groups_of_open_buckets_are_bounded_and_meet_all_pairs(spark, monkeypatch, m):
    """One component of m members and 300 single ones; every pair but those inside the component meets once, in a small group."""
    monkeypatch.setattr(near_dedup, "BLOCK", 20)
    members = spark.createDataFrame([(7, k, 0 if k < m else k) for k in range(m + 300)], "key long, rep long, component long")
    groups = collections.defaultdict(list)
    for r in near_dedup.block_pairs(members).collect():
        groups[r["i"], r["j"]].append((r["side"], r["rep"]))
    assert max(map(len, groups.values())) <= 2 * 2 * 20
    met = collections.Counter()
    for (i, j), group in groups.items():
        for a, (s, x) in enumerate(group):
            for t, y in group[a + 1 :]:
                if i == j or s != t:
                    met[min(x, y), max(x, y)] += 1
    assert met == {(x, y): 1 for x in range(m + 300) for y in range(x + 1, m + 300) if y >= m}


@pytest.mark.parametrize("cells", [1, 50, 4 << 20])
def test_counts_of_common_shingles_come_from_one_product(monkeypatch, cells):
    import numpy as np

    monkeypatch.setattr(near_dedup, "CELLS", cells)
    rng = random.Random(5)
    sets = [np.array(sorted(rng.sample(range(60), rng.choice([1, 5, 30]))), dtype=np.uint64) for _ in range(12)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert near_dedup.common_counts(sets[:5], sets[5:]).tolist() == [row[5:] for row in want[:5]]
    got = near_dedup.common_counts(sets)
    assert all(got[i, j] == want[i][j] for i in range(12) for j in range(12) if i != j)


def test_members_of_open_buckets_are_dealt_once(spark, capsys):
    """Every exchange costs a task a partition, however few the rows; the sums and the join of the buckets share one."""
    near_dedup.block_pairs(spark.createDataFrame([(7, 1, 1), (7, 2, 2)], "key long, rep long, component long")).explain()
    plan = capsys.readouterr().out
    assert 1 <= plan.count("Exchange hashpartitioning") <= 2 and plan.count("Exchange hashpartitioning(key") == plan.count("Exchange")


def test_small_partitions_are_written_together(spark, monkeypatch):
    """Written files follow the rows, not the number of shuffle partitions; the rows stay the same."""
    files, data = {}, [r[:2] for r in rows()]

    def recorded(df, what, *more, plain=common.store):
        out = plain(df, what, *more)
        files[what] = max(files.get(what, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(near_dedup, "store", recorded)
    monkeypatch.setattr(common, "store", recorded)
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 24)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = near_duplicates(frame(spark, rows()), 4, 80).collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert sorted((tuple(r) for r in got), key=str) == near_brute(data, 4, 80)
    once = ("copies", "members", "texts", "pairs", "stars", "round1_labels")
    assert {what: files[what] for what in once} == dict.fromkeys(once, 1)


def test_workers_release_memory_after_each_task(monkeypatch):
    """Also after a task that fails or whose rows are not all asked for."""
    released = []
    monkeypatch.setattr(common, "release_unused", lambda: released.append(1))

    class Frame:
        def mapInArrow(self, fn, schema):
            return fn

    def fails(batches):
        yield from batches
        raise ValueError

    assert list(common.map_arrow(Frame(), lambda batches: (2 * x for x in batches), "")(iter([1, 2]))) == [2, 4]
    assert released == [1]
    some = common.map_arrow(Frame(), lambda batches: batches, "")(iter([1, 2]))
    next(some)
    assert released == [1]
    some.close()
    assert released == [1, 1]
    with pytest.raises(ValueError):
        list(common.map_arrow(Frame(), fails, "")(iter([1])))
    assert released == [1, 1, 1]


def test_near_duplicates_default_parameters_on_a_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = near_duplicates(docs).collect()
    data = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((tuple(r) for r in got), key=str) == near_brute(data, 5, 80)


def test_similarity_bound_is_in_whole_numbers():
    import numpy as np

    a = np.arange(9, dtype=np.uint64)
    assert similar(a[:8], np.concatenate([a[:8], [90, 91]]).astype(np.uint64), 80)  # 8 of 10
    assert not similar(a, np.concatenate([a[:8], [90, 91]]).astype(np.uint64), 80)


def test_segments_follow_the_size_of_the_texts_not_the_partitions(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "concat('word ', id % 7) as text").repartition(40)
    index = phrase_index.build_index(docs)
    assert index.where("term is null").count() == 1 and index.where("term = 'word'").count() == 1
    assert index.where("term is null").selectExpr("size(doc_ids)").first()[0] == 400


def contamination_brute(data, items):
    tok = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t))
    windows = collections.defaultdict(set)
    for item, text in items:
        w = tok(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add(item)
    sizes, out = {len(w) for w in windows}, []
    for doc, text in data:
        w, hit, ids = tok(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    ids |= found
        joined = ",".join(sorted(str(i) for i in ids))
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(joined.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment, block", [(2_000_000, 50_000), (300, 5)])
def test_decontamination(spark, monkeypatch, segment, block):
    monkeypatch.setattr(phrase_index, "SEGMENT_TOKENS", segment)
    monkeypatch.setattr(phrase_index, "BLOCK_WINDOWS", block)
    rng, data = random.Random(3), rows()
    items = [(k, data[rng.randrange(60)][1]) for k in range(12)] + [(50, "one two"), (51, None), (52, "... "), (53, "w1"), (54, "one two"), (55, "not there at all")]
    found = phrase_index.decontaminate(frame(spark, data), frame(spark, items, "item_id long, text string", ("phrase", "term", "doc_id")))
    found = found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids"), 256), "contaminated")
    assert sorted((tuple(r) for r in found.collect()), key=str) == contamination_brute([r[:2] for r in data], items)


def test_decontamination_query(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    want = contamination_brute([(r["doc_id"], r["text"]) for r in docs], [(r["item_id"], r["text"]) for r in items])
    assert sorted((tuple(r) for r in QUERIES["op1_decontaminate"](spark, SF).collect()), key=str) == want
    assert any(r[-1] for r in want)


def test_proximity(spark):
    docs = frame(spark, [(1, "a b c d", None, None, 0), (2, "a b x c d", None, None, 0), (3, "a x y z b c d", None, None, 0), (4, "d c b a", None, None, 0), (5, "a b", None, None, 0), (6, "c d", None, None, 0)])
    phrases = spark.createDataFrame([("a b c d",)], "phrase string")
    found = phrase_index.search(phrase_index.build_index(docs.coalesce(1)), phrases, slop=1).collect()
    assert sorted((r["ordinal"], r["exact"]) for r in found) == [(0, True), (1, False)]
    wider = phrase_index.search(phrase_index.build_index(docs.coalesce(1)), phrases, slop=3).collect()
    assert {r["ordinal"] for r in wider} == {0, 1, 2}  # in the reversed text c is 4 off


def test_postings_code():
    import numpy as np

    values = np.array([0, 5, 300, 2_000_000, 3, 4, 99_999_999], dtype=np.int64)
    data, sizes = phrase_index.pack(values, np.array([4, 3]))
    assert phrase_index.unpack(data[: sizes[0]].tobytes()).tolist() == [0, 5, 300, 2_000_000]
    assert phrase_index.unpack(data[sizes[0] :].tobytes()).tolist() == [3, 4, 99_999_999]


ODD = ["", "a", "<|endoftext|> x", "É.", "e\u0301. x", "don't. it's, 're", "a,. b.,", "x\u00a0y. z\x0bq\x1cr\x85s", "ﬁn. Ⅷ, İstanbul. ΣΑΣ.", "a\u0338. =\u0338 ;\u0301", "日本語. 中文, ", "1. 2, 3.4", "<|ENDOFTEXT|>", "it. it it, it"]


def test_chunk_encoder_is_the_library_on_whole_texts():
    encoder = ChunkEncoder(tokenizer_path(), most=20)
    texts = ODD + [r[1] for r in rows() if r[1]]
    for _ in range(2):
        got = encoder.encode(pa.array(texts, pa.large_string()))
        for t, ids in zip(texts, got, strict=True):
            assert ids.tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids


def test_chunk_encoder_on_slices_of_a_column():
    docs = [r[1] or "" for r in rows()] * 3
    column, encoder = pa.array(docs), ChunkEncoder(tokenizer_path(), most=500)
    for at in range(0, len(docs), 37):
        got = encoder.encode(column.slice(at, 37).cast(pa.large_string()))
        assert [ids.tolist() for ids in got] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in docs[at : at + 37]]


def test_chunk_encoder_on_letters_that_normalise_to_a_mark_at_the_end():
    """Before a stop or comma the pre-tokenizer joins that mark with it."""
    words = ["হয়", "সময়", "\u0958", "\ufb2a", "EV\u0130", "a\u0958", "\u0130", "été", "ΣΑΣ", "слово", "가", "\u1100\u1161", "\u1100\u1161\u11a8", "日本", "abc"]
    encoder = ChunkEncoder(tokenizer_path())
    texts = [w + mark for w in words for mark in (".", ",", "", ".,", "x,", "!!", "***", ".%%%", "'s.", "-", "_", "[x]", "$1.", "<|", "))'")]
    texts += [chr(c) + "," for c in range(0x80, 0x30000) if chr(c).isalpha()]
    for t, ids in zip(texts, encoder.encode(pa.array(texts, pa.large_string())), strict=True):
        assert ids.tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids, t


def test_words_of_plain_letters_go_to_the_model_at_once():
    """The model alone encodes them as the library does; all others still go through the whole tokenizer."""
    rng, encoder = random.Random(5), ChunkEncoder(tokenizer_path())
    plain = [chr(c) for c in encoder.forms]
    assert set("abcxyzéßñçøžжщё") <= set(plain) and not set("İ日σ가\u0301'1") & set(plain)
    words = ["".join(rng.choices(plain, k=rng.randrange(1, 9))) for _ in range(20_000)] + [x for a in plain for x in (a, f"{a}b", f"z{a}", 3 * a)]
    whole = encoder.whole
    want = [whole(w).tolist() for w in words]

    tokenizer = encoder.tokenizer

    class OnlyMarks:
        def encode(self, text, **kw):
            assert not any(map(str.isalpha, text)), text
            return tokenizer.encode(text, **kw)

    encoder.tokenizer = OnlyMarks()
    assert [x.tolist() for x in encoder.encode(pa.array(words))] == want
    encoder.tokenizer = tokenizer
    texts = [f"{a}{mark}{b}" for a, b in zip(words[:3000], words[3000:6000], strict=True) for mark in ("İ", "\u0301", "'", "日", "1", "σ")]
    assert [x.tolist() for x in encoder.encode(pa.array(texts))] == [whole(t).tolist() for t in texts]


def test_chunks_are_looked_up_once_for_many_pieces(monkeypatch):
    """Small pieces are written out, but the distinct chunks of all of them are looked up together; ends follow each text."""
    encoder, calls = ChunkEncoder(tokenizer_path(), most=100), []
    numbers = encoder._numbers
    monkeypatch.setattr(token_store, "BYTES", 300)
    monkeypatch.setattr(encoder, "_numbers", lambda parts: calls.append(len(parts)) or numbers(parts))
    texts = ODD + [r[1] or "" for r in rows()]
    for _ in range(3):
        pieces = list(encoder.lists(pa.array(texts), (1, 7)))
        got = [ids[b - n : b].tolist() for sizes, ids in pieces for n, b in zip(sizes, sizes.cumsum(), strict=True)]
        assert got == [[*encoder.whole(t).tolist(), 1, 7] for t in texts] and len(pieces) > 20
    assert len(calls) == 3 and len(encoder.known) == len(set(encoder.chunks))


def test_token_files(spark):
    from tokenizers import Tokenizer

    data = rows() + [(1000 + k, t, None, None, 0) for k, t in enumerate(ODD)]
    path = shared_path(spark, "tokens")
    write_tokens(frame(spark, data).repartition(7), path, tokenizer_path())
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want, start = [], 0
    for i, t in sorted(((r[0], r[1]) for r in data), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))
        want.append((i, start, len(ids), crc))
        start += len(ids)
    got = [tuple(r) for r in token_digests(spark, path).collect()]
    solid = lambda rs: sorted(r for r in rs if r[0] is not None)
    assert solid(got) == solid(want)
    assert sorted((r[2], r[3]) for r in got) == sorted((r[2], r[3]) for r in want)
    assert sum(r[2] for r in got) == start and len({r[1] for r in got}) == len(got)
    assert read_tokens(spark, path).where("doc_id = 5").select("n_tokens").collect()[0][0] == next(w[2] for w in want if w[0] == 5)


def targets_brute(sizes, share=1.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: CYCLE[k % 3] for k, s in enumerate(order)}
    left, capped = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in capped]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if level * weight[s] >= 3 * sizes[s]]
        if not over:
            return {s: capped.get(s, level * weight[s]) for s in order}
        for s in over:
            capped[s] = 3.0 * sizes[s]
            left -= capped[s]


@pytest.mark.parametrize("buckets", [20_000, 2])
def test_mix(spark, monkeypatch, buckets):
    import upswing.llm.mixing as mixing

    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", buckets)
    data = rows()
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, 0, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    once = mix(frame(spark, data), quality_weights(labels))
    got = once.collect()
    count = lambda t: len([x for x in re.split("[ \t-\r]+", t or "") if x])
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(r[0]), count(r[1])) for r in data)
    sizes = collections.Counter()
    for r in data:
        sizes[r[3]] += count(r[1])
    targets = targets_brute(sizes)
    for source, target in targets.items():
        mine = sorted((r for r in got if r["source"] == source), key=lambda r: (r["key"], str(r["doc_id"]), r["size"]))
        assert all(r["source_size"] == sizes[source] and math.isclose(r["target"], target) for r in mine)
        epochs = math.floor(target / sizes[source]) if sizes[source] else 0
        rest, upto = target - epochs * sizes[source], 0
        for r in mine:
            upto += r["size"]
            assert r["taken"] == r["size"] * (epochs + (upto - r["size"] / 2 <= rest)) <= 3 * r["size"]
        largest = max((r["size"] for r in mine), default=0)
        assert abs(sum(r["taken"] for r in mine) - target) <= largest / 2 + 1e-6
    again = mix(frame(spark, data).repartition(5), quality_weights(labels)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


@pytest.mark.parametrize("weights", [[0.5], [0.05], [20.0], [0.05, 20.0], [0.5, 1.0, 2.0], [0.05 * 1.3**k for k in range(23)]])
def test_key_buckets_are_even_for_any_weights(spark, weights):
    """A source of one weight, of far ones and of many: no bucket holds twice what is aimed at, and buckets follow the keys."""
    import upswing.llm.mixing as mixing

    keyed = spark.range(60_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 50_000, "hot").alias("source"),
        F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("id") % len(weights) + 1).cast("int")).alias("weight"),
    )
    keyed = keyed.withColumn("key", -F.log(mixing.unit_hash("doc_id", F.lit(17))) / F.col("weight"))
    spread = mixing.key_buckets(keyed).withColumnRenamed("source", "s")
    dealt = keyed.join(spread, F.col("source").eqNullSafe(F.col("s"))).withColumn("bucket", mixing.bucket_of(1000))
    groups = dealt.groupBy("source", "bucket").agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
    assert max(g["n"] for g in groups) <= 2000 and sum(g["n"] for g in groups) == 60_000
    for source in ("hot", None):
        mine = sorted((g["bucket"], g["low"], g["high"]) for g in groups if g["source"] == source)
        assert len(mine) >= 8 and all(a[2] <= b[1] for a, b in zip(mine, mine[1:]))


def test_mix_prefers_quality(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.lit("s").alias("source"))
    quality = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0).alias("quality"))
    taken = mix(docs, quality, share=0.3).where("taken > 0").select((F.col("doc_id") % 2 == 0).alias("good")).groupBy("good").count().collect()
    by = {r["good"]: r["count"] for r in taken}
    assert 1150 <= sum(by.values()) <= 1250 and by[True] > 2.5 * by[False]


def lines_brute(data, min_near=20):
    def within_one(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        i = 0
        while i < min(len(a), len(b)) and a[i] == b[i]:
            i += 1
        return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]

    first, out = [], []
    for i, text in data:
        if text is None:
            out.append((i, 0, 0, 0, None))
            continue
        parts, keep, exact, near = text.split("\n"), [], 0, 0
        for line in parts:
            if not line.strip(" "):
                keep.append(line)
                continue
            known = line in first
            upto = first[: first.index(line)] if known else list(first)
            if len(line) >= min_near and any(len(x) >= min_near and within_one(line, x) for x in upto):
                near += 1
            elif known:
                exact += 1
            else:
                keep.append(line)
            if not known:
                first.append(line)
        out.append((i, len(parts), exact, near, "\n".join(keep)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block, few", [(64, 200_000), (8, 0)])
def test_line_dedup(spark, monkeypatch, block, few):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", few)
    rng = random.Random(9)
    long = "".join(rng.choice("abcdé ") for _ in range(9000))
    data = [r for r in rows() if r[0] is not None and r[0] != 95]
    data += [(200, long, None, None, 0), (201, long[:7000] + "!" + long[7000:], None, None, 0), (202, long[:10] + long[11:], None, None, 0)]
    data += [(210 + k, f"a numbered line of some length {k}", None, None, 0) for k in range(10)]
    data += [(230, "a numbered line of some length 33\n\n  \nshort\nshort", None, None, 0)]
    got = line_dedup.dedup_lines(frame(spark, data)).collect()
    assert sorted((tuple(r) for r in got), key=str) == lines_brute(sorted((r[:2] for r in data), key=lambda r: r[0]))


def test_lines_whose_first_hashes_are_equal_stay(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "two_hashes", lambda c: (F.lit(1).cast("long"), F.xxhash64(F.lit(7), c)))
    data = [(1, "this line is quite long\nthis line is unlike it", None, None, 0), (2, "this line is quite long\nthis line is quite lung", None, None, 0)]
    got = line_dedup.dedup_lines(frame(spark, data)).collect()
    assert sorted((tuple(r) for r in got), key=str) == lines_brute([r[:2] for r in data])


def test_line_dedup_nulls_and_repeated_rows(spark):
    data = [(None, "one line\ntwo lines", None, None, 0), (3, "one line", None, None, 0), (3, "one line", None, None, 0), (None, None, None, None, 0)]
    got = line_dedup.dedup_lines(frame(spark, data)).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([(None, 2, 1, 0, "two lines"), (3, 1, 0, 0, "one line"), (None, 0, 0, 0, None)], key=str)


@pytest.mark.parametrize("run", [
    lambda d, s: near_duplicates(d), lambda d, s: phrase_index.decontaminate(d, s.createDataFrame([], "item_id long, text string")),
    lambda d, s: mix(d), lambda d, s: line_dedup.dedup_lines(d),
])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], DOCS), spark).collect() == []


def test_words_and_their_final_marks_are_looked_up_apart():
    """Words with and without marks share an entry, also when they end in letters beyond ASCII or combining marks."""
    encoder, texts = ChunkEncoder(tokenizer_path()), ["abc, Abc. abc été, été;; e\u0301, x\u0301. it's, a1. ?!", "", ", ,abc"]
    got = [x.tolist() for x in encoder.encode(pa.array(texts))]
    assert got == [encoder.whole(t).tolist() for t in texts]
    assert {"abc", "été", ",", ".", ";;", "?!"} <= set(encoder.chunks) and not {"abc,", "abc.", "été,", "été;;"} & set(encoder.chunks)


def test_token_files_of_an_empty_table(spark):
    path = shared_path(spark, "tokens")
    write_tokens(spark.createDataFrame([], DOCS), path, tokenizer_path())
    assert token_digests(spark, path).collect() == []

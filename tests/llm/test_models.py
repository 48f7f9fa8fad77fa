"""Models and the rest: language id, Katz scoring, chat formatting, URL trust, vectors, the pipeline."""

import collections
import hashlib
import math
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import DOCS, SF, components, frame, rows
from upswing.llm import chat, katz, lang_id, url_trust, vector_dedup
from upswing.llm.common import connected_components
from upswing.llm.queries import QUERIES


def test_gradients():
    net = lang_id.Network.fresh(["a", "b", "c"], hidden=3)
    for k in net.PARTS:
        setattr(net, k, getattr(net, k).astype(np.float64))
    rng = np.random.default_rng(0)
    x, y, w = rng.integers(0, 256, (6, 5)), rng.integers(0, 3, 5), rng.random(5)
    _, grads = lang_id.loss_and_gradients(net, x, y, w)
    for k in net.PARTS:
        part = getattr(net, k)
        i = np.unravel_index(np.argmax(np.abs(grads[k])), part.shape)
        was, sides = part[i], []
        for step in (1e-6, -1e-6):
            part[i] = was + step
            sides.append(lang_id.loss_and_gradients(net, x, y, w)[0])
        part[i] = was
        assert math.isclose(grads[k][i], (sides[0] - sides[1]) / 2e-6, rel_tol=1e-4)


def test_labeller_equals_the_trained_network():
    net = lang_id.Network.fresh(["a", "b"], hidden=4)
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (1, 5, 128, 129, 700)]

    def slow(text):
        total = np.zeros(2)
        for at in range(0, len(text), lang_id.SPAN):
            x = np.frombuffer(text[at : at + lang_id.SPAN], dtype=np.uint8)
            states = []
            for d in (0, 1):
                h, seen = np.zeros(4), []
                for b in x if d == 0 else x[::-1]:
                    pre, rec = net.embed[d][:, b], net.recur[d] @ h
                    z, r = (np.clip(0.25 * (pre[k : k + 4] + rec[k : k + 4]) + 0.5, 0, 1) for k in (0, 4))
                    n = pre[8:] + r * (rec[8:] + net.bias[d][:, 0])
                    n = n / (1 + abs(n))
                    h = n + z * (h - n)
                    seen.append(h)
                states.append(seen if d == 0 else seen[::-1])
            for f, b in zip(*states, strict=True):
                logit = net.out[0] @ f + net.out[1] @ b + net.out_bias[:, 0]
                total += np.exp(logit) / np.exp(logit).sum()
        return total / len(text)

    got = lang_id.Labeller(net).documents(texts, block=3)
    assert np.allclose(got, [slow(t) for t in texts], atol=1e-4)


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = QUERIES["op7_lang_id"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) >= 0.95


def test_language_id_edges(spark):
    got = lang_id.identify(frame(spark, rows())).collect()
    assert len(got) == len(rows())
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (90, 91, 92, 93))
    assert all(r["lang_pred"] in ("en", "fr", "und") for r in got)
    nothing = frame(spark, [(1, "text", None, None, 1), (2, None, "en", None, 1)])
    assert {r["lang_pred"] for r in lang_id.identify(nothing).collect()} == {"und"}


def katz_brute(data, seen_in=None):
    tok = lambda t: [*(t or "").encode().lower().split(), None]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    train = [tok(t) for i, t in data if not held(i)]
    uni = collections.Counter(w for t in train for w in t)
    bi = collections.Counter(p for t in train for p in zip([0, *t[:-1]], t, strict=True))

    def spectrum(c):
        n = collections.Counter(c.values())
        return katz.Discount.of([n[r] for r in range(1, katz.CUTOFF + 2)] + [len(c), sum(c.values())])

    du, db = (lambda d: lambda c: float(d(np.array([c]))[0]))(spectrum(uni)), (lambda d: lambda c: float(d(np.array([c]))[0]))(spectrum(bi))
    n, v = sum(uni.values()), len(uni)
    unknown = 1 - sum(du(c) for c in uni.values()) / n
    p1 = lambda w: du(uni[w]) / n if w in uni else unknown
    hist, lost, mass = collections.Counter(), collections.Counter(), collections.Counter()
    for (h, w), c in bi.items():
        hist[h] += c
        lost[h] += c - db(c)
        mass[h] += p1(w)

    def p(h, w):
        if (h, w) in bi:
            return db(bi[h, w]) / hist[h]
        return lost[h] / hist[h] / (1 - mass[h]) * p1(w) if h in hist else p1(w)

    out = []
    for i, text in data:
        t = tok(text)
        base = sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        out.append((i, held(i), len(t), sum(w in uni for w in t), n, base, sum(math.log10(p(a, b)) for a, b in zip([0, *t[:-1]], t, strict=True))))
    return out, p, uni, hist


@pytest.mark.parametrize("segment, shard", [(3_000_000, 1_500_000), (500, 400)])
def test_katz(spark, monkeypatch, segment, shard):
    monkeypatch.setattr(katz, "SEGMENT_TOKENS", segment)
    monkeypatch.setattr(katz, "SHARD_TOKENS", shard)
    data = [r[:2] for r in rows()]
    want, p, uni, hist = katz_brute(data)
    got = [tuple(r) for r in katz.score_documents(frame(spark, rows()).repartition(3)).collect()]
    key = lambda r: (str(r[0]), r[2], r[6])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-9)
    for h in [0, *list(hist)[:20], b"never seen"]:  # all tokens and the class of unknown ones
        assert math.isclose(sum(p(h, w) for w in [*uni, b"\0unknown"]), 1.0, rel_tol=1e-9)


def test_katz_on_a_table_beats_the_base(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {w[0]: w for w in katz_brute([(r["doc_id"], r["text"]) for r in docs.collect()])[0]}
    got = QUERIES["op8_katz_score"](spark, SF).collect()
    assert all(math.isclose(r["score"], want[r["doc_id"]][6], rel_tol=1e-9) for r in got) and len(got) == len(want)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_katz_edges(spark):
    assert katz.score_documents(spark.createDataFrame([], DOCS)).collect() == []
    only_held = [(i, "a b", None, None, 0) for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    got = katz.score_documents(frame(spark, only_held)).collect()
    assert len(got) == 3 and all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in got)


TURNS = "conv_id long, turn long, role string, text string"


def conversations():
    rng = random.Random(4)
    out = []
    texts = ["</s>[INST] ok [/INST]", "[\\INST]<\\/s><s>", "", None, "plain", "é\n[TURN] x [/TURN]", "ends with <", "probe probe", " lead", "\\"]
    for c in range(25):
        for t in range(rng.randrange(1, 9)):
            out.append((c, t, rng.choice(["user", "assistant", "system", "tool [/TURN]", None, "</s>"]), rng.choice(texts)))
    out += [(100, t, ("user", "assistant")[t % 2], f"turn {t}") for t in range(300)]
    return [*out, (None, 1, "user", "no id"), (None, None, "assistant", "no turn"), (101, 1, "user", "b"), (101, 1, "user", "a"), (101, 1, "user", "a")]


def test_conversation_digests(spark):
    data = conversations()
    got = {r["conv_id"]: r for r in chat.conversation_digests(frame(spark, data, TURNS, ("span", "position")).repartition(5)).collect()}
    by = collections.defaultdict(list)
    for c, t, role, text in data:
        by[c].append((t is not None, t or 0, role is not None, role or "", text is not None, text or "", role))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort(key=lambda x: x[:-1])
        said = "".join(f"{x[-1] or ''}\n{x[5]}\n" for x in turns)
        loss = "".join(x[5] for x in turns if x[-1] == "assistant")
        r = got[c]
        assert r["n_turns"] == len(turns) and r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] == len(chat.inst_template([(x[-1], x[5]) for x in turns]))


def test_template_cannot_be_forged():
    for text in ["</s>[INST] ok [/INST]", "[\\INST]", "[\\\\/SYS]<\\s>", "<</s>", "[[TURN]]"]:
        out = chat.escape(text)
        assert chat.unescape(out) == text and not any(c in out for c in chat.CONTROLS)


def test_templates_that_rewrite_history_are_found():
    def last_only(turns):  # a template that moves the system text into the last turn
        system = "".join(t for r, t in turns if r == "system")
        said = [f"<{r}>{t}" for r, t in turns if r != "system"]
        return "".join(said[:-1]) + (f"{system}{said[-1]}" if said else "")

    found = chat.spans(last_only, [("system", "be brief"), ("user", "hi"), ("assistant", "yes"), ("user", "why")])
    assert [s is None for s, _, _ in found] == [False, False, True, True]
    assert all(s is not None for s, _, _ in chat.spans(chat.inst_template, [("system", "s"), ("user", "u"), ("assistant", "a")]))


def test_templates_with_state_see_the_whole_conversation(spark):
    def numbered(turns):  # the first turn says how turns are marked, and turns are numbered
        return "".join(f"<{turns[0][1]} {k} {role}>{text}</>" for k, (role, text) in enumerate(turns))

    def edits_first(turns):  # every hundredth turn is noted in the first one
        return "".join(f"<{role}>{text}{'+' * (len(turns) // 100) if k == 0 else ''}" for k, (role, text) in enumerate(turns))

    data = [(c, t, ("user", "assistant")[t % 2], f"said {t}") for c in (1, 2) for t in range(130)]
    for template in (numbered, edits_first):
        want = chat.spans(template, [r[2:] for r in data[:130]])
        got = chat.format_conversations(frame(spark, data, TURNS), template).collect()
        for c in (1, 2):
            mine = sorted((r for r in got if r["conv_id"] == c), key=lambda r: r["position"])
            assert [(r["span"], r["content_from"], r["content_to"]) for r in mine] == want
            assert [r["position"] for r in mine if r["rewrites"]] == ([99] if template is edits_first else [])
            if template is numbered:
                assert "".join(r["span"] for r in mine) == numbered([r[2:] for r in data[:130]])


def test_digests_of_a_long_conversation_with_a_stateful_template(spark):
    def numbered(turns):  # every turn says how many came before it and how the first one began
        return "".join(f"<{turns[0][1][:4]} {k} {role}>{chat.escape(text)}</{k}>" for k, (role, text) in enumerate(turns))

    def parse(span):
        head, rest = span.split(">", 1)
        first, k, role = head[1:].split(" ")
        assert first == "said" and rest.endswith(f"</{k}>")
        return role, chat.unescape(rest[: -len(f"</{k}>")])

    data = [(9, t, ("user", "assistant")[t % 2], f"said {t} </s>") for t in range(300)]
    (got,) = chat.conversation_digests(frame(spark, data, TURNS), numbered, parse).collect()
    said = [r[3] for r in data if r[2] == "assistant"]
    assert (got["n_turns"], got["loss_chars"]) == (300, sum(map(len, said)))
    assert got["turns_sha256"] == hashlib.sha256("".join(f"{r[2]}\n{r[3]}\n" for r in data).encode()).hexdigest()
    assert got["loss_sha256"] == hashlib.sha256("".join(said).encode()).hexdigest()
    assert got["formatted_chars"] == len(numbered([r[2:] for r in data]))


def test_windows_of_a_stateless_template_change_nothing(spark):
    data = frame(spark, conversations(), TURNS, ("span", "position"))
    key = lambda rs: sorted(map(tuple, rs.collect()), key=str)
    assert key(chat.format_conversations(data)) == key(chat.format_conversations(data, window=7))


def test_chat_query_and_empty_table(spark):
    got = {r["conv_id"]: r for r in QUERIES["op5_chat_format"](spark, SF).collect()}
    n = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
    assert len(got) == n + 1 and got[-7]["loss_chars"] == 21
    assert chat.conversation_digests(spark.createDataFrame([], TURNS)).collect() == []


def rule_brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for rule, verdict in url_trust.RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, best


URLS = ["http://EXAMPLE.org/es/1", "https://a.b.example.org/en/12?x", "x://net", "nourl", None, "", "http://com/fr/x#y", "a://b.com/de/", "q://é.Org", "http://org/a/b?c", "://org/", "http://notexample.org/es/", "a://example.org/es", "a://b://com/fr/", "http://x.com\n/fr/", "http://org?x", "http://h0/", "http://h1/", "http://h2/", "http://h3/", "http://h4/"]


def test_url_rules_and_propagation(spark):
    link = lambda *hosts: "".join(f'<a HREF = "https://{h}/p">' for h in hosts) + '<a href="/local">'
    htmls = {"http://org/a/b?c": link("h0", "H1"), "http://h0/": link("h2"), "http://h3/": link("b.com", "b.com"), "http://h4/": link("h3", "org"), "http://h1/": None}
    pages = [(i, u, htmls.get(u, "<p>")) for i, u in enumerate(URLS)] + [(None, "http://h3/", None), (16, "http://h0/", link("h2"))]
    got = url_trust.filter_urls(frame(spark, pages, "page_id long, url string, html string", ("host", "path", "src", "score"))).collect()
    assert len(got) == len(pages)
    edges = collections.Counter()
    for _, u, html in pages:
        src = rule_brute(u)[0]
        for dst in {h.lower() for h in __import__("re").findall(r"(?i)href = \"https://([^/]+)", html or "")}:
            if src and src != dst:
                edges[src, dst] += 1
    seeds = collections.defaultdict(collections.Counter)
    for _, u, _ in pages:
        host, _, rule = rule_brute(u)
        if rule:
            seeds[rule[1]][host] += 1

    def rank(seed, edges):
        s = {h: c / sum(seed.values()) for h, c in seed.items()}
        out, score = collections.Counter(), {h: 0.15 * v for h, v in s.items()}
        for (a, _), w in edges.items():
            out[a] += w
        for _ in range(60):
            new = collections.Counter({h: 0.15 * v for h, v in s.items()})
            for (a, b), w in edges.items():
                new[b] += 0.85 * score.get(a, 0) * w / out[a]
            score = new
        return score

    trust, distrust = rank(seeds["allow"], edges), rank(seeds["block"], {(b, a): w for (a, b), w in edges.items()})
    for r in got:
        host, path, rule = rule_brute(URLS[r["page_id"]] if r["page_id"] is not None else "http://h3/")
        judged = "block" if distrust.get(host, 0) > trust.get(host, 0) else "allow"
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule and rule[0], rule[1] if rule else judged)
    assert {r["host"]: r["verdict"] for r in got if r["rule"] is None}["h3"] == "block"


@pytest.mark.parametrize("edges", [[("a", "b", 1), ("b", "a", 1)], [("a", "b", 2), ("b", "c", 1), ("c", "a", 3), ("a", "d", 1), ("d", "d2", 1), ("c", "b", 1)]])
def test_propagation_on_cycles_is_the_solution_of_its_equations(spark, edges):
    hosts, seed = sorted({h for e in edges for h in e[:2]}), {"a": 3, "b": 1}
    step = np.zeros((len(hosts), len(hosts)))
    for src, dst, weight in edges:
        step[hosts.index(dst), hosts.index(src)] += weight / sum(w for s, _, w in edges if s == src)
    start = np.array([seed.get(h, 0) / 4 for h in hosts])
    want = np.linalg.solve(np.eye(len(hosts)) - 0.85 * step, 0.15 * start)
    table = spark.createDataFrame(edges, "src string, dst string, weight long")
    got = url_trust.personalised_pagerank(table, spark.createDataFrame(list(seed.items()), "host string, seed long"), "cycle")
    got = {r["host"]: r["score"] for r in got.collect()}
    assert sum(abs(got.get(h, 0.0) - w) for h, w in zip(hosts, want, strict=True)) < url_trust.TOLERANCE
    assert url_trust.rounds_to(1e-6) == 86


def test_url_query_on_a_table(spark):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op6_url_trust"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        host, path, rule = rule_brute(pages[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0]) and (not rule or r["verdict"] == rule[1])
    assert url_trust.filter_urls(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def vectors_brute(data, threshold=0.9):
    data = [(i, v) for i, v in dict.fromkeys((i, tuple(v) if v is not None else None) for i, v in data)]
    good = [(i, np.array(v, float) / np.linalg.norm(v)) for i, v in data if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and np.linalg.norm(v) > 0]
    near = [(i, j) for i, x in good for j, y in good if i != j and len(x) == len(y) and x @ y >= threshold]
    n = collections.Counter(i for i, _ in near)
    comp = components([i for i, _ in data if i is not None], near)
    return n, comp


@pytest.mark.parametrize("block, cell", [(2048, 250), (7, 20)])
def test_vectors(spark, monkeypatch, block, cell):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    monkeypatch.setattr(vector_dedup, "CELL", cell)
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 16))
    data = [(k, (base[k % 40] + 0.08 * rng.standard_normal(16)).astype(np.float32).tolist()) for k in range(200)]
    data += [(300 + k, data[0][1]) for k in range(30)] + [(400, None), (401, []), (402, [0.0] * 16), (403, [1.0, None] * 8), (404, [float("nan")] + [1.0] * 15), (405, [float("inf")] * 16), (406, [1.0, 2.0]), (407, [2.0, 4.0]), (None, data[0][1]), (1, data[1][1])]
    got = vector_dedup.near_vectors(frame(spark, data, "vec_id long, embedding array<float>", ("rep", "home", "label"))).collect()
    n, comp = vectors_brute(data)
    assert len(got) == len(data)
    found = sum(r["n_links"] for r in got)
    assert all(r["n_links"] <= n[r["vec_id"]] for r in got) and found >= 0.97 * sum(n.values())
    for r in got:
        assert r["component_id"] == (None if r["vec_id"] is None else comp[r["vec_id"]])
        assert r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"])


@pytest.mark.parametrize("dim, block, cell", [(4, 2048, 20), (16, 2048, 20), (16, 11, 20), (64, 2048, 15)])
def test_vectors_of_links_just_above_the_threshold(spark, monkeypatch, dim, block, cell):
    """Planted pairs at cosine 0.90 to 0.92, which often cross borders: all links are counted for both vectors, once."""
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    monkeypatch.setattr(vector_dedup, "CELL", cell)
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    a = unit(rng.standard_normal((400, dim)))
    other = rng.standard_normal((400, dim))
    other = unit(other - (other * a).sum(axis=1, keepdims=True) * a)
    cos = rng.uniform(0.901, 0.92, (400, 1))
    both = np.concatenate([a, cos * a + np.sqrt(1 - cos**2) * other])
    data = [(k, v.tolist()) for k, v in enumerate(both)] + [(2000 + k, both[k].tolist()) for k in range(0, 800, 7)]
    got = vector_dedup.near_vectors(frame(spark, data, "vec_id long, embedding array<double>")).collect()
    n, comp = vectors_brute(data)
    assert min(n.values()) >= 1 and len(n) == len(data)
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {i: (n[i], comp[i]) for i, _ in data}


def test_vectors_are_stored_once_not_for_each_cell(spark, monkeypatch):
    """Pairs of groups read the stored vectors: none are shuffled for the cells they may link in, nor written for them."""
    tables, plans = {}, {}

    def seen(df, what):
        plans[what] = df._jdf.queryExecution().executedPlan().toString()
        tables[what] = store(df, what)
        return tables[what]

    store = vector_dedup.store
    monkeypatch.setattr(vector_dedup, "store", seen)
    monkeypatch.setattr(vector_dedup, "CELL", 20)
    x = np.random.default_rng(8).standard_normal((2000, 64)).astype(np.float32)
    df = frame(spark, [(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    assert sum(r["n_links"] for r in vector_dedup.near_vectors(df).collect()) == 0
    written = sum(os.path.getsize(f.removeprefix("file://")) for t in tables.values() for f in t.inputFiles())
    assert "Exchange" not in plans["links"]
    assert written < 3 * x.nbytes


@pytest.mark.parametrize("group, block, most", [(40, 2048, 6 << 20), (100_000, 16, 64 * 4 * 50)])
def test_vectors_of_many_groups(spark, monkeypatch, group, block, most):
    """Links inside groups and between them, one by one and in dense groups of near copies, in vectors of two lengths."""
    for name, value in {"GROUP": group, "GROUP_BYTES": most, "BLOCK": block, "CELL": 10}.items():
        monkeypatch.setattr(vector_dedup, name, value)
    rng = np.random.default_rng(6)
    rows = [x for dim in (64, 24) for x in rng.standard_normal((120, dim))]
    rows += [rows[k] + rng.uniform(0.02, 0.065) * rng.standard_normal(len(rows[k])) for k in [0] * 90 + [200] * 60 + list(range(100, 140))]
    data = [(k, x.tolist()) for k, x in enumerate(rows)]
    data += [(1000 + k, data[k][1]) for k in (0, 0, 100, 5)]
    data = [data[k] for k in rng.permutation(len(data))]
    got = vector_dedup.near_vectors(frame(spark, data, "vec_id long, embedding array<double>")).collect()
    n, comp = vectors_brute(data)
    assert max(n.values()) > 60 and len(got) == len(data)
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {i: (n[i], comp[i]) for i, _ in data}


def test_vectors_whose_first_hashes_are_equal_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "two_hashes", lambda c: (F.lit(1).cast("long"), F.xxhash64(F.lit(7), c)))
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0]), (4, [0.96, 0.28])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vector_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (2, 1), 2: (0, 2), 3: (2, 1), 4: (2, 1)}


def test_vectors_on_a_table(spark):
    sf = "/root/testdata/sf0.01"
    n, comp = vectors_brute([(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()])
    got = QUERIES["op9_vector_dedup"](spark, sf).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {i: (n[i], c) for i, c in comp.items()}
    assert vector_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_components_of_chains_and_stars(spark):
    rng = random.Random(7)
    edges = [(k, k + 1) for k in range(500, 540)] + [(1000, k) for k in range(1001, 1200)] + [(rng.randrange(300), rng.randrange(300)) for _ in range(120)]
    want = components({x for e in edges for x in e}, edges)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: c for n, c in want.items() if n in got} and all(n in got or c == n for n, c in want.items())


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline
    from tests.llm.test_documents import contamination_brute, near_brute

    docs = frame(spark, rows())
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = docs.unionByName(frame(spark, [(500, "before " + items[0][1] + " after", "en", "a", 1)]))
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "token_output"]
    for name, stage in pipeline.STAGES:
        before = docs.collect()
        out = stage(spark, docs, SF)
        after = out.collect()
        if name != "token_output":
            assert out.columns == docs.columns
        if name == "language_id":
            gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
            assert {90, 91, 92, 93} <= gone and len(after) >= len(before) - 8
        if name == "near_dedup":
            want = [r[0] for r in near_brute([(r["doc_id"], r["text"]) for r in before], 5, 80) if r[3]]
            assert sorted((r["doc_id"] for r in after), key=str) == sorted([i for i in set(want) if i is not None] + [i for i in want if i is None], key=str)
        if name == "decontamination":
            clean = [r[0] for r in contamination_brute([(r["doc_id"], r["text"]) for r in before], items) if not r[-1]]
            assert sorted((r["doc_id"] for r in after), key=str) == sorted(clean, key=str) and 500 not in clean
        if name == "mixing":
            assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before} and max(collections.Counter(r["doc_id"] for r in after).values()) <= 3
        if name == "token_output":
            assert sorted(str(r["doc_id"]) for r in after) == sorted(str(r["doc_id"]) for r in before)
        docs = spark.createDataFrame(after, out.schema)


def test_pipeline_runs_on_a_table_and_on_nothing(spark, tmp_path):
    import corpus_pipeline as pipeline

    assert pipeline.run(spark, SF).count() > 50
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{table}.parquet").limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert pipeline.run(spark, str(tmp_path)).collect() == []


def test_pipeline_judges_rows_that_share_a_doc_id_by_their_texts(spark):
    """Equal and null doc_ids with different texts, some of them copies, near copies or contaminated: no clean row goes."""
    import corpus_pipeline as pipeline

    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 100").first()["text"]
    clean = ["wholly other words about rivers and stones " + f"number {k} " * 9 for k in range(6)]
    data = [(7, clean[0]), (7, f"x {item} y"), (None, clean[1]), (None, f"z {item}"), (8, clean[2]), (8, clean[3]), (8, clean[3]), (9, clean[4]), (10, clean[4])]
    docs = frame(spark, [(i, t, "en", "s", len(t)) for i, t in data])
    kept = pipeline.drop_contaminated(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(str(r) for r in data if item not in r[1])
    one = pipeline.drop_near_duplicates(spark, kept, SF).collect()
    want = [(7, clean[0]), (None, clean[1]), (8, clean[2]), (8, clean[3]), (9, clean[4])]
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in one))) == sorted(map(str, want))
    mixed = pipeline.mix_sources(spark, docs, SF)
    assert mixed.columns == docs.columns
    assert collections.Counter((r["doc_id"], r["text"]) for r in mixed.collect()) == collections.Counter(data)  # one source: each row once


def test_rows_are_not_dealt_while_no_doc_id_is_shared(spark, capsys):
    """Each exchange of the rows costs about their size on disk."""
    import corpus_pipeline as pipeline

    docs = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c")], "doc_id long, text string")
    pipeline._documents(docs).explain()
    assert "Exchange hashpartitioning" not in capsys.readouterr().out
    shared = pipeline._documents(docs.unionAll(docs.selectExpr("doc_id", "concat(text, 'x')"))).collect()
    assert len({r["_id"] for r in shared}) == 6 and all(r["_id"] >= 1 << 62 for r in shared)


def test_messages_of_the_count_tables_are_smaller_than_their_values():
    rng = np.random.default_rng(3)
    keys = np.sort(rng.integers(0, 1 << 63, 20_000).astype(np.uint64) * np.uint64(2))
    sent = katz._six(keys)
    assert len(sent) < 5.5 * len(keys) and (katz._from_six(sent) == keys >> np.uint64(16)).all()
    for values in (np.array([], dtype=np.int32), rng.integers(0, 99, 1000), rng.random(7)):
        assert (katz._unpack(katz._pack(values), values.dtype) == values).all()
    assert len(katz._from_six(katz._six(keys[:0]))) == 0

"""Small tables with the cases every operator must stand: nulls, empties, long texts, ties, repeats, clashing columns."""

import random

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"
#: Columns whose names the operators use inside.
EXTRA = ("size", "score", "segment", "row", "kept", "key", "body", "part", "quality", "copies", "train", "line", "rep")


def words(rng, n, kinds=60):
    return " ".join(rng.choice([f"Wört{k}", f"w{k}", f"W{k}x", f"é{k}"]) for k in (rng.randrange(kinds) for _ in range(n)))


def rows(seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(60):
        text = words(rng, rng.choice([1, 3, 8, 40, 120]))
        out.append((i, text, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "é", None]), len(text)))
    base = words(rng, 100, 400).split()
    for i in range(60, 75):  # near copies of one text, some of them chained
        w = list(base)
        for _ in range(i - 60):
            w[rng.randrange(len(w))] = f"new{rng.randrange(9)}"
        out.append((i, " ".join(w), "en", "a", 0))
    out += [(i, out[3][1], "en", "b", 0) for i in range(75, 90)]  # exact copies
    out += [(90, None, None, None, None), (91, "", "en", "a", 0), (92, " \n\t ", None, "b", 3), (93, "... !!", "fr", "a", 5)]
    out += [(None, out[3][1], "en", "a", 0), (None, None, None, None, None), (95, "one two", "en", "a", 1), (95, "one two", "en", "a", 1)]
    out += [(96, words(rng, 30_000, 5000), "en", "c", 1), (97, "x" * 70_000, "en", "c", 1), (98, "z\u00a0y\u2003x\x1cw\x0bv", "en", "c", 1)]
    lines = [words(rng, 6) for _ in range(8)]
    for i in range(100, 120):
        some = []
        for _ in range(6):
            line = rng.choice(lines)
            at = rng.randrange(len(line))
            some.append(rng.choice([line, line, line[:at] + line[at + 1 :], line[:at] + "q" + line[at:], line[:at] + "q" + line[at + 1 :], "", "short"]))
        out.append((i, "\n".join(some), "en", "a", 0))
    return out


def frame(spark, data, schema=DOCS, extra=EXTRA):
    df = spark.createDataFrame(data, schema)
    return df.select("*", *[F.lit("clash").alias(c) for c in extra if c not in df.columns])


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}

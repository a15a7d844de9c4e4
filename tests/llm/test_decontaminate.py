"""Benchmark decontamination against brute force, with short, long, repeated and odd items."""

from __future__ import annotations

import random
import re

from strata.llm import decontaminate


def brute_force(docs, items, percent=80):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    out = {}
    for d, t in docs:
        for i, q in items:
            w = words(q)
            n = min(5, len(w))
            if not n:
                continue
            g = grams(w, n)
            shared = len(g & grams(words(t), n))
            if shared * 100 >= percent * len(g):
                out[d, i] = max(out.get((d, i), (0, 0, 0)), (shared / len(g), shared, len(g)))
    return sorted(((d, i, q, s, c) for (d, i), (c, s, q) in out.items()), key=str)


def planted():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghijkä") for _ in range(rng.randint(2, 7))) for _ in range(150)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([14, 20, 33, 60, 130, 5, 4, 3])] + [(20, None), (21, ""), (22, "a a a a a a a a a")]
    docs = []
    for d in range(60):
        body = text(rng.randint(0, 400)).split()
        if rng.random() < 0.7:
            item = (rng.choice(items)[1] or "").split()
            cut = rng.randint(0, len(item) // 4)
            at = rng.randint(0, len(body))
            body[at:at] = [w.upper() + "," for w in item[cut:]]
        docs.append((d, " ".join(body)))
    return docs + [(60, None), (61, ""), (None, items[1][1]), (3, items[2][1]), docs[5]], items


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equal_brute_force(spark):
    docs, items = planted()
    got = rows(decontaminate.contained(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")))
    assert got == brute_force(docs, items)
    assert len(got) > 15


def test_no_python_in_the_plan(spark):
    docs, items = planted()
    out = decontaminate.contained(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    out = decontaminate.contained(docs, items)
    assert out.collect() == [] and out.columns == ["doc_id", "item_id", "n_item_shingles", "n_shared", "containment"]
    assert decontaminate.contained(docs.limit(0), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).collect() == []

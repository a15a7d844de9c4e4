"""Alignment of two vocabularies against whole-text brute force; the monoid's laws."""

from __future__ import annotations

import hashlib
import random

import brute
import numpy as np
import pytest

from strata.llm import align

SCHEMA = "doc_id long, text string"
SIGNS = [*"abcXYZ 019'.,!?\n\t", " the", " of", "in ", " ", "　", "é", "ß", "日本", "語", "한", "😀", "ж", "ﬁ", "'s", "<|endoftext|>", "</s>", "  \n", "aaaa"]


def corpus():
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice(SIGNS) for _ in range(n))
    rows = [(k, text(rng.randint(1, 40))) for k in range(150)]
    rows += [(400, text(6000)), (401, "x" * 9000), (402, "日本語" * 2000), (403, "a▁b" * 2000), (404, "a▁b"), (405, None), (406, ""), (407, " " * 5000)]
    rows += [(408, "".join(rng.choice("日本語漢字仮名交文aé") for _ in range(4000))), (None, "no id"), (None, text(3000)), (7, rows[7][1]), (409, " ")]
    return rows + [(500 + k, "the same words again and again") for k in range(60)]


def got(df):
    return sorted((tuple(r)[:8] for r in df.collect()), key=str)


@pytest.mark.parametrize("size", [64, 1000, align.RANGE])
def test_equals_brute_force(spark, size):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], SCHEMA + ", groups long").repartition(5)
    documents, pairs = align.align(docs, keep_groups=True, size=size)
    want, counts = brute.op11(rows)
    assert got(documents) == want
    assert {(r.a, r.b): (r["count"], r.best) for r in pairs.collect()} == counts
    for r in documents.collect():
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")


def test_composition_is_associative():
    """Any bracketing of the ranges of a text closes the same groups."""
    own, rng = align.aligner(None), random.Random(8)
    for trial in range(60):
        body = (" " + "".join(rng.choice(SIGNS) for _ in range(120))).encode()
        if "▁".encode() in body:
            continue
        found = []
        for row in align.ranges(own, body, rng.choice([5, 20, 60])):
            closed = []
            a, b = own.tokens(own.a, row["prefix_a"]), own.tokens(own.b, row["prefix_b"])
            found.append((own.fragment(row["k"], row["prefix_a_at"], a, row["prefix_b_at"], b, closed), closed))
        texts = set()
        for _ in range(4):
            parts = list(found)
            while len(parts) > 1:
                k = rng.randrange(len(parts) - 1)
                closed = [*parts[k][1], *parts[k + 1][1]]
                parts[k : k + 2] = [(own.composed(parts[k][0], parts[k + 1][0], closed), closed)]
            end, closed = parts[0]
            assert end.cut and not any(map(len, (end.prefix.a, end.prefix.b, end.suffix.a, end.suffix.b)))
            sizes = lambda r: (r.a.tolist(), own.a.sizes[r.a].tolist(), r.b.tolist(), own.b.sizes[r.b].tolist())
            texts.add(";".join(align.linked(*sizes(r))[0] for r in sorted(closed, key=lambda r: r.a_at)))
        assert len(texts) == 1 and hashlib.sha256(texts.pop().encode()).hexdigest() == brute.op11([(1, body[1:].decode())])[0][0][-1]


def test_a_pair_comes_once_a_block(spark):
    rows = [(k, "one two three one two") for k in range(40)] + [(k, f"word{k} one") for k in range(40, 60)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    documents, _ = align.align(docs)
    assert got(documents) == brute.op11(rows)[0]
    block = align.Block(3)
    for d, t in rows:
        block.add(align.aligner(None).words, [f for p in align.aligner(None).cutter.blocks(b" " + t.encode()) for f in p], {"doc_id": d}, False)
    head = block.closed()[0]
    assert len(head["pairs"]) == len(np.unique(head["pairs"]))


def test_empty_table(spark):
    documents, pairs = align.align(spark.createDataFrame([], SCHEMA))
    assert documents.collect() == [] and pairs.collect() == []
    assert documents.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_only_texts_without_tokens(spark):
    rows = [(1, None), (2, ""), (3, "a▁b"), (4, "▁" * 3000)]
    documents, pairs = align.align(spark.createDataFrame(rows, SCHEMA), size=500)
    assert got(documents) == [(d, 0, 0, 0, 0, 0, 0, "") for d, _ in rows] and pairs.collect() == []

"""Forced-boundary encoding and decoding against the tokenizers library on whole texts."""

from __future__ import annotations

import random

import brute
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import bpe, vocab

SCHEMA = "doc_id long, text string"
SIGNS = [*"abcXYZ 019'.,!?\n\t\r\x00\x1c\x85", " ", " ", "　", "᠎", "﻿", "é", "ß", "日", "本", "한", "😀", "́", "٣", "Ж", "▁",
         "'s", "'re", "'LL", "  \n", "\n\n", "   ", "<|endoftext|>", "<|endof", "</s>"]


def drawn(seed: int, n: int, most: int):
    rng = random.Random(seed)
    return ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, most))) for _ in range(n)]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_every_pair_is_cut_or_inside_a_token():
    v = bpe.vocabulary()
    text = "x the 日本 naïve café 'twas\n\n  ok".encode()
    for fragments in v.cutter.blocks(text):
        joined = b"".join(fragments)
        assert joined == text
        at = 0
        for f in fragments[:-1]:
            at += len(f)
            assert not v.cutter.inside[joined[at - 1], joined[at]] and joined[at] & 0xC0 != 0x80


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(SIGNS), max_size=30))
def test_ids_equal_the_library(parts):
    text, v = "".join(parts), bpe.vocabulary()
    ids = np.frombuffer(b"".join(v.encoded(text.encode())), "<u4").tolist()
    assert ids == brute.json_tokenizer_once().encode(text, add_special_tokens=False).ids
    assert "".join(bpe.decoded(v, iter([np.array(ids, "<u4").tobytes()]))) == text


def test_digest_equals_brute_force(spark):
    rows = list(enumerate(drawn(1, 400, 40)))
    rows += [(500, None), (501, ""), (None, "no id"), (7, rows[7][1]), (502, "x" * 5000), (503, "日本語" * 900), (504, " \t\n" * 700), (505, "<|endoftext|>" * 40)]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], SCHEMA + ", ids string").repartition(4)
    assert got(bpe.digest(docs)) == brute.op13(rows)


def test_blocks_end_at_cuts():
    v = bpe.vocabulary()
    text = " ".join(drawn(2, 300, 20)).replace("<|endoftext|>", "")
    for size in (16, 100, 5000):
        parts = [b"".join(x) for x in v.cutter.blocks(text.encode(), size)]
        assert b"".join(parts).decode() == text
        ids = [i for p in parts for i in brute.json_tokenizer_once(plain=True).encode(p.decode(), add_special_tokens=False).ids]
        assert ids == brute.json_tokenizer_once(plain=True).encode(text, add_special_tokens=False).ids


def test_very_long_texts(spark):
    rows = [(1, " " * 2_000_000), (2, "\n" * 1_500_000), (3, "word and 日本 " * 100_000), (4, "a" * 300_000)]
    assert got(bpe.digest(spark.createDataFrame(rows, SCHEMA))) == brute.op13(rows)


def test_round_trip_and_odd_ids(spark):
    rows = [(k, t, k * 2) for k, t in enumerate([*drawn(3, 60, 30), None, ""])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded long")
    out = bpe.decode(bpe.encode(docs)).collect()
    assert all(r.decoded == (r.text or "") and r.n_tokens == len(r.ids) for r in out) and len(out) == 62
    odd = spark.createDataFrame([([None, 64, -5, 10**6],), (None,), ([],), ([162, 50256],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(odd).collect()] == ["a", None, "", "�<|endoftext|>"]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert got(bpe.digest(none)) == [] and got(bpe.encode(none)) == []


def test_frequent_fragments_stay_known(monkeypatch):
    monkeypatch.setattr(vocab, "CACHE_SIZE", 10)
    made = []
    known = vocab.Known(lambda new: made.extend(new) or [f + b"!" for f in new])
    for k in range(200):
        assert known.of([b"often", b"%d" % k, b"often"]) == [b"often!", b"%d!" % k, b"often!"]
    assert made.count(b"often") == 1 and len(known.young) + len(known.old) < 50

"""Best-fit packing: exact round trip, gapless bins, odd rows, merging rounds."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import packing

SCHEMA = "doc_id long, text string"


def docs(seed=3, n=300):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghéß ") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(int(rng.paretovariate(1) * 20) % 3000))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (None, "x y"), (4, rows[4][1]), (n + 2, "<|endoftext|> a")]


def test_pieces_are_the_ids_of_the_tokenizer(spark):
    rows = docs()
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = []
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or min(len(ids), 1024)
        edges = [0, *range(first, len(ids) + 1, 1024)]
        want += [(d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    cut = packing.pieces(spark.createDataFrame(rows, SCHEMA).repartition(4))
    got = [tuple(r) for r in cut.select("doc_id", "piece", "start", "length", F.crc32("ids")).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_long_runs_of_white_space(spark):
    """Runs that the rank file's encoder fails on, and the lengths around the switch."""
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    n = packing.SAFE_SPACE
    texts = [" " * 2_000_000, "a" + "\n" * 2_000_000 + "b <|endoftext|>", "x" + " " * n + "y", "x" + "\t" * (n + 1) + "y", " \u3000\r\n" * n + "z"]
    for text in texts[2:]:
        assert packing.token_ids(text) == t.encode(text, add_special_tokens=False).ids
    rows = packing.pieces(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).groupBy("doc_id").agg(F.sum("length").alias("n"))
    assert {r.doc_id: r.n for r in rows.collect()} == {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in enumerate(texts)}


def check_bins(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_every_piece_once_and_bins_gapless_and_few(spark):
    rng = random.Random(1)
    lengths = [(i, rng.randint(1, 1024) if rng.random() < 0.7 else rng.randint(1, 60)) for i in range(6000)]
    items = spark.createDataFrame(lengths, "id long, length long").repartition(12)
    out = packing.pack(items).collect()
    assert sorted((r.id, r.length) for r in out) == sorted(lengths)
    least = -(-sum(n for _, n in lengths) // 1024)
    assert check_bins(out, 1024) <= 1.01 * least


def test_merging_rounds_lower_the_bins(spark):
    items = spark.createDataFrame([(i, 300 + i % 7) for i in range(64)], "id long, length long").repartition(16)
    many = packing.pack(items, group_bins=8).collect()
    one = packing.pack(items).collect()
    assert check_bins(one, 1024) == 22  # three to a bin
    assert check_bins(many, 1024) <= 26


def test_best_fit_takes_the_tightest_bin():
    where, at, fill = packing.best_fit(np.array([600, 700, 300, 400, 24]), 1024)
    assert fill.tolist() == [1024, 1000] and where.tolist() == [1, 0, 0, 1, 0] and at.tolist() == [0, 0, 700, 600, 1000]


def test_sequences_hold_the_ids(spark):
    rows = docs(5, 40)
    cut = packing.pieces(spark.createDataFrame(rows, SCHEMA))
    seq = packing.sequences(packing.pack(cut)).collect()
    assert sum(r.n_tokens for r in seq) == cut.agg(F.sum("length")).first()[0]
    assert all(len(r.ids) == 4 * r.n_tokens <= 4096 for r in seq)


def test_empty_and_clashing_columns(spark):
    assert packing.pack(packing.pieces(spark.createDataFrame([], SCHEMA))).collect() == []
    items = spark.createDataFrame([(1, 5, 9, 9, 9), (2, 6, 9, 9, 9)], "id long, length long, bin long, sequence_id long, offset long")
    out = packing.pack(items).collect()
    assert check_bins(out, 1024) == 1 and out[0].asDict().keys() == {"id", "length", "sequence_id", "offset"}

"""Operators 4 and 8 against brute force: planted repeats, copies, oversized groups, odd rows."""

from __future__ import annotations

import random
from dataclasses import replace

import brute
import numpy as np
import pyarrow as pa
import pytest

from strata.llm import repeats, substring, suffix_array

SCHEMA = "doc_id long, text string"


def corpus(seed: int, n: int = 60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    text = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passages = [text(25) for _ in range(4)]
    rows = []
    for d in range(n):
        body = text(rng.randint(0, 60))
        if rng.random() < 0.4:
            body = f"{text(rng.randint(0, 9))} {rng.choice(passages)}\n{body}"
        if rng.random() < 0.1:
            body = "la la la " * rng.randint(1, 30) + body
        rows.append((d, body))
    rows += [(n, rows[3][1]), (n + 1, rows[3][1]), (3, rows[3][1])]  # copies; a repeated row
    rows += [(n + 2, None), (n + 3, ""), (None, rows[5][1] + " x"), (n + 4, " \t\n ")]
    rows += [(n + 5, "z" * 500), (n + 6, "ab" * 200)]
    return rows


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("group_bytes", [1 << 20, 300])
def test_bytes_equal_brute_force(spark, group_bytes):
    kind = repeats.Kind(window=40, gram=16, words=False, shard_bytes=4000, group_bytes=group_bytes)
    rows = corpus(1)
    out = suffix_array.digest(spark.createDataFrame(rows, SCHEMA).repartition(5), kind)
    assert got(out) == brute.op8(rows, 40)


@pytest.mark.parametrize("group_bytes", [1 << 20, 300])
def test_words_equal_brute_force(spark, group_bytes):
    kind = repeats.Kind(window=9, gram=4, words=True, shard_bytes=4000, group_bytes=group_bytes)
    rows = corpus(2)
    out = substring.digest(spark.createDataFrame(rows, SCHEMA).repartition(5), kind)
    assert got(out) == brute.op4(rows, 9)


def test_production_windows(spark):
    rng = random.Random(4)
    text = lambda k: " ".join("".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(k))
    passage = text(90)
    rows = [(d, text(30) + " " + passage[: 350 + 10 * d] + " " + text(20)) for d in range(12)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert got(suffix_array.digest(docs)) == brute.op8(rows, 400)
    assert got(substring.digest(docs)) == brute.op4(rows, 35)


@pytest.mark.parametrize("size", [399, 400])
def test_a_passage_of_60_words_goes_from_400_bytes_on(spark, size):
    """What was removed stands in n_removed; n_bytes is the whole text's length, removed or not."""
    rng = random.Random(6)
    word = lambda k: "".join(rng.choice("abcdefg") for _ in range(k))
    passage = " ".join([*[word(5) for _ in range(59)], word(size - 59 * 6)])
    rows = [(1, f"{word(9)}1{passage}2{word(9)}"), (2, f"{word(30)}3{passage}4{word(5)}"), (3, word(size))]
    assert len(passage) == size and len(passage.split()) == 60
    out = got(suffix_array.digest(spark.createDataFrame(rows, SCHEMA)))
    assert out == brute.op8(rows, 400)
    assert [(r[1], r[2]) for r in out] == [(len(t), size if size == 400 and d < 3 else 0) for d, t in rows]


def test_long_text_is_cut_in_overlapping_pieces(monkeypatch):
    rng = random.Random(9)
    text = " ".join(rng.choice(["a", "bb", "ccc", "dddd"]) for _ in range(3000)).encode()
    for words, size in ((False, len(text)), (True, len(text.split()))):
        kind = repeats.Kind(window=30, gram=12, words=words)
        monkeypatch.setattr(repeats, "BLOCK", 1000)
        seen = np.zeros(size, int)
        for values, lengths, first, before in repeats.text_blocks([b"x", text, b""], kind):
            t, _, _, a, b = repeats.anchors(values, lengths, kind)
            for i, x, y in zip(t + first, a + before, b + before):
                assert i == 1
                seen[x : y + 1] += 1
        assert (seen[: size - 29] == 1).all() and not seen[size - 29 :].any()


def test_empty_table_and_extra_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert got(suffix_array.digest(none)) == [] and got(substring.digest(none)) == []
    rows = [(1, "w " * 300, "x"), (2, "w " * 300, "y"), (3, "short", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    out = {r.doc_id: r for r in suffix_array.deduplicate(docs).collect()}
    assert bytes(out[1].kept) == b"" and bytes(out[3].kept) == b"short" and out[2].n_removed == 600
    out = {r.doc_id: r for r in substring.deduplicate(docs).collect()}
    assert out[1].kept == "" and out[1].n_removed == 300 and out[3].kept == "short"


def test_group_widths_end_at_one_window():
    assert replace(suffix_array.BYTES).width(0) == 201 and suffix_array.BYTES.width(3) == 1 and substring.WORDS.width(2) == 1


class Stream:
    """Stands in for a frame, so that a task's function can be driven by hand."""

    def mapInArrow(self, run, schema):
        return run

    def __getattr__(self, name):
        return lambda *a, **k: self


def test_a_hot_group_streams(spark):
    """One group of distinct spans, far over its size, at the end of a partition: spans go on while the group is read."""
    kind = repeats.Kind(window=40, gram=16, words=False, shard_bytes=4000, group_bytes=200_000)
    run = repeats.sort_groups(Stream(), kind, lambda shard, kind: [])
    read, sent, size = 0, 0, 1000

    def batches():
        nonlocal read
        for k in range(0, 30_000, size):
            rows = [(7, i, i, 0, 24, 25, 0, b"%064d" % i) for i in range(k, k + size)]
            read += size
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), repeats.SPAN_TYPES)], names=repeats.SPAN_NAMES)

    start = kind.group_bytes // 64 + 1
    for b in run(batches()):
        assert b.num_rows <= repeats.DEFERRED
        sent += b.num_rows
        assert read - sent <= start + repeats.DEFERRED + size
        assert set(b.column(6).to_pylist()) == {1}
    assert sent == read == 30_000

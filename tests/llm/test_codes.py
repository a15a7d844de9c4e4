"""Product codes by dual trees against plain search over Python integers."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from strata.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(seed: int, n: int, length: int = 32, steps: int = 0):
    rng = random.Random(seed)
    one = lambda: rng.randint(-steps, steps) / 256 if steps else rng.gauss(0, 0.2)
    return [(k * 3, [float(np.float32(one())) for _ in range(length)], rng.choice([1, 2, 3, None])) for k in range(n)]


def odd(rows):
    length, inf = len(rows[0][1]), float("inf")
    out = rows + [(10_000, None, 1), (10_001, [None] + [0.0] * (length - 1), 1), (10_002, [float("nan")] * length, 2), (10_003, [inf] * length, 2)]
    out += [(5, rows[4][1], None), (5, rows[8][1], None), (None, rows[9][1], 2), rows[3], rows[3]]
    return out + [(20_000 + k, rows[2][1], 7) for k in range(300)]  # one very common vector


@pytest.mark.parametrize("rows", [odd(vectors(1, 300)), odd(vectors(2, 400, 16, 3)), vectors(3, 5), vectors(4, 64)], ids=["spread", "ties", "few", "entries"])
def test_equals_plain_search(spark, rows):
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", code string").repartition(3)
    assert got(codes.digest(docs)) == brute.op12(rows)


@pytest.mark.parametrize("width,spread", [(1, 2), (2, 5), (4, 300), (8, 50)])
def test_trees_equal_plain_search(width, spread):
    rng = np.random.default_rng(width)
    for n in (1, 2, 15, 17, 33, 500, 4096):
        points = rng.integers(-spread, spread + 1, (n, width))
        book = rng.integers(-spread, spread + 1, (min(n, 64), width))
        order, depth = codes.halved(points, codes.LEAF)
        tree = codes.PartTree.over(points[order], depth)
        entry, sums, counts = codes.assigned(tree, codes.EntryTree.over(book))
        distance = ((points[order][:, None] - book[None]) ** 2).sum(axis=2)
        assert (entry == distance.argmin(axis=1)).all()
        assert (counts == np.bincount(entry, minlength=len(book))).all()
        for k in range(len(book)):
            assert (sums[k] == points[order][entry == k].sum(axis=0)).all()


def test_whole_nodes_are_assigned_by_their_sums(monkeypatch):
    """Well separated clusters are settled without looking at single points."""
    centres = np.array([[0, 0], [10_000, 0], [0, 10_000], [10_000, 10_000]])
    points = np.repeat(centres, 256, axis=0) + np.random.default_rng(1).integers(0, 9, (1024, 2))
    order, depth = codes.halved(points, codes.LEAF)
    monkeypatch.setattr(codes, "settle", None)
    _, _, counts = codes.assigned(codes.PartTree.over(points[order], depth), codes.EntryTree.over(centres))
    assert counts.tolist() == [256] * 4


def test_several_blocks_a_task(spark, monkeypatch):
    rows = vectors(6, 500)
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    shape, _ = codes.first_vectors(codes.whole(docs), 64, 16, 256)
    sizes = [len(r.vec_ids) for r in codes.blocks(codes.whole(docs.union(docs).union(docs).coalesce(1)), shape, 256).collect()]
    assert sum(sizes) == 1500 and max(sizes) <= codes.BLOCK


def test_lengths_and_ranges(spark):
    """Other lengths and components out of range go; a length that is no multiple of the parts is filled up."""
    rows = vectors(7, 30, 20)
    more = [(100, [0.5] * 19, 1), (101, [], 1), (102, [1e30] * 20, 1), (103, [-3e38] + [0.0] * 19, 1)]
    out = codes.digest(spark.createDataFrame(rows + more, SCHEMA)).collect()
    assert sorted(r.vec_id for r in out) == sorted(r[0] for r in rows)
    padded = [(v, e + [0.0] * 12, label) for v, e, label in rows]
    want = {r[0]: r[1:4] for r in brute.op12(padded)}
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in out} == want


def test_empty_tables(spark):
    for rows in ([], [(1, None, 1), (2, [], 1)]):
        assert got(codes.digest(spark.createDataFrame(rows, SCHEMA))) == []


def test_decompressed_vectors_are_close(spark):
    rows = vectors(9, 600, 64)
    found, books = codes.compress(spark.createDataFrame(rows, SCHEMA))
    by_id = {r[0]: r[1] for r in rows}
    for r in codes.decompress(found, books, 64).collect():
        error = sum((256 * a - 256 * b) ** 2 for a, b in zip(r.approximation, by_id[r.vec_id]))
        assert abs(error**0.5 - r.error**0.5) <= 8 + 1e-6  # half a step for each of 64 components

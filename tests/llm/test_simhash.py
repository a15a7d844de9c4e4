"""SimHash near-dedup: fingerprints, the ring's completeness, oversized buckets, odd rows."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import simhash

SCHEMA = "doc_id long, text string"


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4), st.integers(5, 9))
def test_a_pair_within_the_distance_passes_at_some_key(fp, flips, segments):
    other = fp
    for b in flips:
        other ^= 1 << b
    ring = simhash.Ring(tuple(range(64)), 4, segments)
    x = np.array([fp ^ other], np.uint64)
    assert any(not (fp ^ other) & mask and simhash.pair_mask(x, ring, k, 4)[0] for k, mask in enumerate(ring.masks))


def test_inner_rings_keep_completeness_and_shrink():
    rng = random.Random(2)
    for _ in range(50):
        x = sum(1 << b for b in rng.sample(range(64), 4))
        paths = [()]
        for _ in range(3):
            nxt = []
            for p in paths:
                ring = simhash.ring_of(p, 4, 7)
                nxt += [(*p, k) for k, mask in enumerate(ring.masks) if not x & mask and simhash.pair_mask(np.array([x], np.uint64), ring, k, 4)[0]]
            assert nxt
            paths = nxt[:3]
    assert len(simhash.ring_of((0, 0, 0), 4, 7).bits) < len(simhash.ring_of((0,), 4, 7).bits) < 64
    assert simhash.path_of(simhash.BASE * 3 + 5) == (2, 4)


def corpus():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgABCÉé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    rows = []
    for d in range(40):
        body = [rng.choice(words) for _ in range(rng.randint(0, 300))]
        rows.append((d, " ".join(body)))
        if rng.random() < 0.5 and len(body) > 3:
            body[rng.randrange(len(body))] = "changed"
            rows.append((100 + d, "\t".join(body)))
    rows += [(200, rows[1][1].upper()), (201, None), (202, ""), (203, " \n"), (None, rows[2][1]), (5, rows[5][1]), (204, "one two"), (None, "only this text has no id at all")]
    return rows


@pytest.mark.parametrize("limit", [20_000, 16])
def test_equal_brute_force(spark, limit):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = simhash.near_duplicates(docs, bucket_limit=limit).collect()
    assert sorted(((r.doc_id, f"{r.fp % 2**64:016x}", r.component_id) for r in out), key=str) == brute.op2(rows)


@pytest.mark.parametrize("limit", [20_000, 16])
def test_a_dense_group_links_as_by_brute_force(spark, limit):
    """Hundreds of fingerprints a few bits around one centre, and chains: more than a bucket may hold."""
    from strata.llm.common import Scratch
    from strata.llm.components import components

    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = {centre}
    while len(fps) < 150:
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    chain = rng.getrandbits(64)
    for _ in range(30):
        fps.add(chain)
        chain ^= sum(1 << b for b in rng.sample(range(64), 4))
    fps |= {rng.getrandbits(64) for _ in range(100)}
    signed = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    scratch = Scratch(spark, "simhash-test")
    edges = scratch.save(simhash.links(spark.createDataFrame(signed, "fp long"), scratch, bucket_limit=limit))
    roots = {r.node: r.root for r in components(edges, scratch).collect()}
    groups = brute.linked(sorted(fps), lambda a, b: (a ^ b).bit_count() <= 4)
    for f in fps:
        s = int(np.uint64(f).view(np.int64))
        want = min(int(np.uint64(g).view(np.int64)) for g in groups[f])
        assert roots.get(s, s) == want


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []

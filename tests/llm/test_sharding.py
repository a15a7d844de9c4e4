"""Extendible hashing against a plain directory; hot keys, odd rows, written shards."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

from strata.llm import sharding

SCHEMA = "doc_id long, text string"


def bits(value):
    return f"{int(hashlib.md5(('\x00' if value is None else str(value)).encode()).hexdigest()[:15], 16):060b}"


def directory(rows, limit):
    out, todo = {}, [("", rows)]
    while todo:
        prefix, own = todo.pop()
        size = sum(len((t or "").encode()) for _, t in own)
        if size <= limit or len(own) == 1:
            for d, _ in own:
                out[d] = (prefix, size)
        else:
            for b in "01":
                part = [r for r in own if bits(r[0])[len(prefix)] == b]
                if part:
                    todo.append((prefix + b, part))
    return out


def test_equal_plain_directory(spark):
    rng = random.Random(2)
    rows = [(i, "é" * rng.randint(0, 200)) for i in range(500)] + [(1000, None), (1001, "x" * 5000), (None, "abc")]
    want = directory(rows, 1500)
    out = sharding.assign(spark.createDataFrame(rows, SCHEMA).repartition(4), limit=1500).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.shard, r.shard_bytes) == want[r.doc_id] and r.depth == len(r.shard)


def test_a_hot_key_is_split_further(spark):
    rows = [(7, "x" * 100)] * 90 + [(i, "y" * 10) for i in range(100)]
    out = sharding.assign(spark.createDataFrame(rows, SCHEMA).repartition(5), limit=1000).collect()
    sizes = defaultdict(int)
    for r in out:
        sizes[r.shard] += r.n_bytes
    assert len(out) == 190 and max(sizes.values()) <= 1000
    assert all(r.shard_bytes == sizes[r.shard] for r in out)


def test_empty_clashing_and_written(spark, scratch):
    assert sharding.assign(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([(i, "z" * 50, "s") for i in range(40)], "doc_id long, text string, depth string")
    assert sharding.assign(docs, limit=300).columns == ["doc_id", "n_bytes", "shard", "depth", "shard_bytes"]
    sharding.write_shards(docs.drop("depth"), f"{scratch}/shards", limit=300)
    back = spark.read.parquet(f"{scratch}/shards")
    sizes = back.selectExpr("shard", "octet_length(text) AS n").groupBy("shard").sum("n").collect()
    assert back.count() == 40 and max(r[1] for r in sizes) <= 300 and len(sizes) > 6

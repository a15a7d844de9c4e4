"""Sharding by extendible hashing (operator 5).

Every row's key has a string of hash bits. The directory starts with one bucket
and only buckets over the byte limit are split on their next bit, so a shard is a
bit prefix and neighbouring shards may have different depths.

The directory is found from sums, not by moving rows: row sizes are added up per
cell (a prefix some bits deeper than the open buckets), cells are rolled up to
every shorter prefix, and a bucket is the longest-lived prefix that fits. Buckets
that are still too large at cell depth go round again with more bits. Rows with
one key share all their bits; where these alone exceed the limit (a hot key), the
split goes on over the bits of each row's number, so no key forces a large shard.

Only a bucket of one row may exceed the limit. Defined cases: a null text has no
bytes; a null key is a key like others; repeated rows are rows of their own; an
empty table has no shards; extra columns pass through unless named like an output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch

LIMIT = 1 << 20
BITS = 60
STEP = 12


def hash_bits(value: Column) -> Column:
    """The first 60 bits of the MD5 of a value as text, as a long."""
    return F.conv(F.substring(F.md5(F.coalesce(value.cast("string"), F.lit("\u0000"))), 1, 15), 16, 10).cast("long")


def _prefix(h: Column, depth: int) -> Column:
    return F.shiftright(h, BITS - depth)


def bits_text(prefix: Column, depth: Column) -> Column:
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(prefix), depth, "0"))


def _split(rows: DataFrame, limit: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Buckets of (label, h, size) rows within each label.

    Returns (label, h, shard, depth, shard_bytes) per distinct (label, h) that is in
    a bucket, and the (label, h) whose rows exceed the limit at full depth.
    """
    keys = scratch.save(rows.groupBy("label", "h").agg(F.sum("size").alias("size"), F.count("*").alias("n")))
    open_keys, placed, depth = keys, None, 0
    while True:
        deep = min(BITS, depth + STEP)
        cells = open_keys.groupBy("label", _prefix(F.col("h"), deep).alias("cell")).agg(F.sum("size").alias("size"), F.sum("n").alias("n"))
        cells = scratch.save(cells)
        levels = F.explode(F.sequence(F.lit(depth), F.lit(deep))).alias("d")
        nodes = cells.select("label", "cell", "size", "n", levels).withColumn("p", F.expr(f"shiftright(cell, {deep} - d)"))
        nodes = nodes.groupBy("label", "d", "p").agg(F.sum("size").alias("shard_bytes"), F.sum("n").alias("n"))
        fits = nodes.where((F.col("shard_bytes") <= limit) | (F.col("n") == 1))
        mapped = cells.select("label", "cell", levels).withColumn("p", F.expr(f"shiftright(cell, {deep} - d)")).join(fits, ["label", "d", "p"])
        chosen = mapped.groupBy("label", "cell").agg(F.min(F.struct("d", "p", "shard_bytes")).alias("b"))  # the least depth that fits
        chosen = scratch.save(chosen.select("label", "cell", "b.d", "b.p", "b.shard_bytes"))
        joined = open_keys.withColumn("cell", _prefix(F.col("h"), deep)).join(chosen, ["label", "cell"], "left")
        joined = scratch.save(joined.select("label", "h", "size", open_keys["n"], "d", "p", "shard_bytes"))
        done = joined.where("d IS NOT NULL").select("label", "h", bits_text(F.col("p"), F.col("d")).alias("shard"), F.col("d").alias("depth"), "shard_bytes")
        placed = done if placed is None else placed.unionByName(done)
        open_keys, depth = joined.where("d IS NULL").select("label", "h", "size", "n"), deep
        if deep == BITS or open_keys.isEmpty():
            return placed, open_keys.select("label", "h")


def assign(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Rows of ``docs`` without their text: n_bytes, shard (its bits), depth and shard_bytes."""
    scratch = Scratch(docs.sparkSession, "sharding")
    added = ("n_bytes", "shard", "depth", "shard_bytes")
    own = [c for c in docs.columns if c not in (*added, text)]
    size = F.octet_length(F.coalesce(text, F.lit(""))).cast("long")
    # numbered once and written, so that a row keeps its number when a task is repeated
    rows = scratch.save(docs.select(*own, size.alias("n_bytes"), hash_bits(F.col(key)).alias("__h"), F.monotonically_increasing_id().alias("__row")))
    flat = rows.select(F.lit("").alias("label"), F.col("__h").alias("h"), F.col("n_bytes").alias("size"))
    placed, hot = _split(flat, limit, scratch)
    hot = scratch.save(hot)
    placed = placed.select(F.col("h").alias("__h"), "shard", "depth", "shard_bytes")
    out = rows.join(placed, "__h").select(*own, *added)
    if hot.isEmpty():
        return out
    # a hot key: go on with the bits of the row numbers, each key by itself
    late = rows.join(hot.select(F.col("h").alias("__h")), "__h", "left_semi").withColumn("h", hash_bits(F.col("__row")))
    late = late.withColumn("label", bits_text(F.col("__h"), F.lit(BITS)))
    more, _ = _split(late.select("label", "h", F.col("n_bytes").alias("size")), limit, scratch)
    more = more.select("label", "h", F.concat("label", "shard").alias("shard"), (F.col("depth") + BITS).alias("depth"), "shard_bytes")
    return out.unionByName(late.join(more, ["label", "h"]).select(*own, *added))


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> None:
    """Writes the rows under ``path``, one folder a shard (``shard=b<bits>``). A shard fits a task, as its bytes are bounded."""
    scratch = Scratch(docs.sparkSession, "sharding-write")
    numbered = scratch.save(docs.withColumn("__n", F.monotonically_increasing_id()))
    placed = assign(numbered.select("__n", key, text), key, text, limit).select("__n", "shard")
    numbered.join(placed, "__n").drop("__n").withColumn("shard", F.concat(F.lit("b"), "shard")).repartition("shard").write.partitionBy("shard").parquet(path)


ORACLE = f"""
WITH r AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), chr(0))), 1, 15) AS BIGINT) AS h FROM documents),
x AS (SELECT r.*, d, h >> ({BITS} - d) AS p FROM r CROSS JOIN (SELECT unnest(generate_series(0, 40)) AS d)),
s AS (SELECT d, p, sum(n_bytes) AS b, count(*) AS n FROM x GROUP BY d, p),
f AS (SELECT doc_id, n_bytes, h, min(x.d) AS depth FROM x JOIN s ON x.d = s.d AND x.p = s.p WHERE b <= {LIMIT} OR n = 1 GROUP BY ALL)
SELECT f.doc_id, f.n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(h >> ({BITS} - depth)), CAST(depth AS INTEGER), '0') END AS shard,
       CAST(depth AS INTEGER) AS depth, CAST(s.b AS BIGINT) AS shard_bytes
FROM f JOIN s ON s.d = f.depth AND s.p = h >> ({BITS} - depth)"""

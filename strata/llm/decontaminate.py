"""Benchmark decontamination (operator 7): size-partitioned MinHash containment search.

Items are partitioned by the number of their distinct five-word shingles. Every
partition has its sketch size: the smallest MinHash values of an item, so many
that an item contained to ``percent`` per cent must leave a known number of them
in the document. Documents are probed whole against the sketches (a sketch of a
long document would lose short items); candidate pairs are then verified by
exact containment on the shingles' own words. The search has no false
negatives: of q shingles at most ``q - ceil(q * percent / 100)`` may be absent,
and a sketch holds more than that.

Only DataFrame functions are used. The join of a document's shingles with the
sketches is on the 64-bit hash; Spark broadcasts the sketches while they are
under its byte threshold and shuffles beyond it.

Words are runs of letters, marks and digits, lower-cased. An item under five
words is one shingle of its own length; one without words never matches, as does
a null text on either side. Rows of ``docs`` that share a doc_id are judged one by
one and the largest containment is returned; a null doc_id is a value like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch

SHINGLE = 5
PERCENT = 80
SPARE = 4  # sketch values beyond the least number that proves containment possible


def words(text: Column) -> Column:
    """Lower-cased words of letters, marks and digits; empty for null."""
    flat = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{M}\\p{N}]+", " "))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def windows(w: str, length: int, make) -> Column:
    """``make`` on every run of ``length`` words; empty if there are fewer."""
    n = F.size(w)
    return F.when(n >= length, F.transform(F.sequence(F.lit(1), n - (length - 1)), lambda i: make(F.slice(F.col(w), i, F.lit(length)))))


def item_shingles(items: DataFrame) -> DataFrame:
    """(item_id, length, q, shingle): distinct shingles of every item."""
    w = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(SHINGLE))
    s = w.select("item_id", length.alias("length"), F.array_distinct(
        F.transform(F.sequence(F.lit(1), F.size("w") - length + 1), lambda i: F.concat_ws(" ", F.slice(F.col("w"), i, length)))).alias("s"))
    return s.dropDuplicates(["item_id", "s"]).select("item_id", "length", F.size("s").alias("q"), "s")


def sketches(shingles: DataFrame, percent: int) -> DataFrame:
    """(item_id, length, need, h): the smallest hash values of each item, by size partition."""
    bits = F.floor(F.log2(F.col("q").cast("double")) + F.lit(1e-9)).cast("int")  # sizes 2^b to 2^(b+1)-1
    upper = F.expr("shiftleft(1, size_class + 1) - 1")
    absent = F.floor(F.col("q") * (100 - percent) / 100)
    take = F.least(F.col("q"), (F.floor(upper * (100 - percent) / 100) + 1 + SPARE).cast("int"))
    hashes = F.array_sort(F.transform("s", lambda x: F.xxhash64(F.split(x, " "))))
    return shingles.withColumn("size_class", bits).select(
        "item_id", "length", (take - absent).cast("int").alias("need"), F.explode(F.slice(hashes, F.lit(1), take)).alias("h"))


def contained(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared, containment) of every pair at ``percent`` or more."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    shingles = scratch.save(item_shingles(items))
    sketch = scratch.save(sketches(shingles, percent))
    lengths = sorted(r[0] for r in shingles.select("length").distinct().collect())  # five at most
    keyed = docs.select("doc_id", F.xxhash64("text").alias("k"), "text")
    texts = keyed.select("doc_id", "k", words(F.col("text")).alias("w"))
    pairs = None
    for n in lengths:
        probe = texts.select("doc_id", "k", F.explode(F.array_distinct(windows("w", n, F.xxhash64))).alias("h"))
        hits = probe.join(sketch.where(F.col("length") == n), "h")
        hits = hits.groupBy("doc_id", "k", "item_id", "need").agg(F.count("*").alias("n")).where("n >= need").select("doc_id", "k", "item_id")
        pairs = hits if pairs is None else pairs.unionByName(hits)
    if pairs is None:
        item = F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id")
        return keyed.limit(0).select("doc_id", item, *[F.lit(0).cast(t).alias(c) for c, t in (("n_item_shingles", "int"), ("n_shared", "long"), ("containment", "double"))])
    pairs = scratch.save(pairs)
    wanted = pairs.select("doc_id", "k").distinct()
    own = keyed.alias("d").join(wanted.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.k") == F.col("c.k")), "left_semi")
    own = own.select("doc_id", "k", words(F.col("text")).alias("w"))
    found = None
    for n in lengths:
        said = own.select("doc_id", "k", F.explode(F.array_distinct(windows("w", n, lambda s: F.concat_ws(" ", s)))).alias("shingle"))
        asked = shingles.where(F.col("length") == n).select("item_id", "q", F.explode("s").alias("shingle"))
        shared = said.join(asked, "shingle").groupBy("doc_id", "k", "item_id", "q").agg(F.count_distinct("shingle").alias("n_shared"))
        found = shared if found is None else found.unionByName(shared)
    p = pairs.select("doc_id", "k", "item_id").distinct().alias("p")
    found = found.alias("f").join(
        p, F.col("f.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("f.k") == F.col("p.k")) & F.col("f.item_id").eqNullSafe(F.col("p.item_id")), "left_semi")
    found = found.where(F.col("n_shared") * 100 >= F.col("q") * percent)
    out = found.groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("n_shared") / F.col("q")).alias("c"), "n_shared", "q")).alias("m"))
    return out.select("doc_id", "item_id", F.col("m.q").alias("n_item_shingles"), "m.n_shared", F.col("m.c").alias("containment"))


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{M}}\\p{{N}}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{M}}\\p{{N}}]+') AS w FROM benchmark),
bl AS (SELECT item_id, w, least(len(w), {SHINGLE}) AS n FROM b WHERE len(w) > 0),
bs AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT item_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM bl)),
q AS (SELECT item_id, count(*) AS q FROM bs GROUP BY item_id),
ds AS (SELECT DISTINCT rid, doc_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM
       (SELECT rid, doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d JOIN (SELECT DISTINCT n FROM bl) ON len(w) >= n)),
h AS (SELECT rid, doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (n, s) GROUP BY ALL)
SELECT doc_id, item_id, CAST(max(q) AS INTEGER) AS n_item_shingles, CAST(max(n_shared) AS BIGINT) AS n_shared, max(n_shared / q) AS containment
FROM h JOIN q USING (item_id) WHERE n_shared * 100 >= q * {PERCENT} GROUP BY doc_id, item_id"""

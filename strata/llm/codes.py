"""Vector code compression (operator 12): product codes trained by dual-tree Lloyd rounds.

A vector is cut into parts; each part position has a codebook of integer entries, and
a vector's code is the index of the nearest entry for each of its parts.

Two trees meet. One is over the parts of a block of vectors (halved along the widest
side, boxes and sums at every node), one over the entries of the part's codebook. A
pair of nodes has a least and a greatest distance, from their boxes. A node of parts
drops every node of entries that is further away than some other one is at most. When
one entry is left, the whole node goes to it, with the node's cached sum and count.
Leaves that stay uncertain are settled point by point in integers. All bounds are
integers too, so the result is that of plain search, ties to the lower index.

Spark's side: blocks of at most ``BLOCK`` vectors are built once, with their trees'
orders, and written; each round reads them, and every task sends one sum and one
count for each entry. These are added up by groups, and the driver gets the new
codebooks only, whose size is that of ``entries`` vectors.

Defined cases: rows whose vector is null or has a null, NaN or infinite component are
dropped, and so are vectors with a component beyond the range in which squared
distances fit 64 bits (``reach``; 524,288 for 64 components) and vectors that are not
as long as the first one (smallest vec_id, nulls last, then smallest vector). Of equal
vec_ids every row stands for itself. A length that is no multiple of the number of parts is
filled up with zeros. With fewer vectors than entries the codebooks are shorter; an
empty table gives no rows. Null labels form one group. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StringType, StructField, StructType

from strata.llm.common import Scratch

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
BLOCK = 4096  # vectors of a block
LEAF = 16  # at most so many parts in a leaf, on average


def reach(width: int) -> int:
    """Largest magnitude of a component for which the squared distances of 16 parts of ``width`` add up in 64 bits."""
    return math.isqrt((1 << 58) // max(1, width)) // 2


def halved(points: np.ndarray, leaf: int) -> tuple[np.ndarray, int]:
    """Order of ``points`` by a tree that halves every node along its widest side, and its depth."""
    order, depth = np.arange(len(points)), 0
    while len(points) >> depth > leaf:
        edges = bounds(len(points), depth)
        p = points[order]
        wide = np.maximum.reduceat(p, edges[:-1]) - np.minimum.reduceat(p, edges[:-1])
        node = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        value = p[np.arange(len(p)), wide.argmax(axis=1)[node]]
        order, depth = order[np.lexsort((value, node))], depth + 1
    return order, depth


def bounds(n: int, depth: int) -> np.ndarray:
    """Edges of the 2**depth nodes over n points; a level's edges are edges of the next one."""
    return (np.arange((1 << depth) + 1) * n) >> depth


@dataclass
class PartTree:
    """Levels of boxes and sums over the ordered parts of a block."""

    points: np.ndarray
    depth: int
    low: list[np.ndarray]
    high: list[np.ndarray]
    total: list[np.ndarray]

    @classmethod
    def over(cls, points: np.ndarray, depth: int) -> PartTree:
        at = bounds(len(points), depth)[:-1]
        low, high, total = [np.minimum.reduceat(points, at)], [np.maximum.reduceat(points, at)], [np.add.reduceat(points, at)]
        for _ in range(depth):
            low.insert(0, np.minimum(low[0][::2], low[0][1::2]))
            high.insert(0, np.maximum(high[0][::2], high[0][1::2]))
            total.insert(0, total[0][::2] + total[0][1::2])
        return cls(points, depth, low, high, total)


@dataclass
class EntryTree:
    """Nodes over the distinct entries of a codebook; a node's children are -1 where it is one entry."""

    entries: np.ndarray
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray
    second: np.ndarray
    entry: np.ndarray

    @classmethod
    def over(cls, entries: np.ndarray) -> EntryTree:
        # of equal entries the lowest index wins every tie, so the others are left out
        distinct = np.sort(np.unique(entries, axis=0, return_index=True)[1])
        rows: list[list] = []

        def build(own: np.ndarray) -> int:
            e, me = entries[own], len(rows)
            rows.append([e.min(axis=0), e.max(axis=0), -1, -1, int(own[0]) if len(own) == 1 else -1])
            if len(own) > 1:
                by = own[np.argsort(e[:, (rows[me][1] - rows[me][0]).argmax()], kind="stable")]
                rows[me][2:4] = build(by[: len(by) // 2]), build(by[len(by) // 2 :])
            return me

        build(distinct)
        return cls(entries, *[np.array(c) for c in zip(*rows)])


def assigned(tree: PartTree, book: EntryTree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry of each point, sums of the points of each entry, their counts)."""
    n, k = len(tree.points), len(book.entries)
    out = np.full(n, -1, np.int64)
    sums, counts = np.zeros_like(book.entries), np.zeros(k, np.int64)
    node, against, depth = np.zeros(1, np.int64), np.zeros(1, np.int64), 0
    while len(node):
        low, high = tree.low[depth][node], tree.high[depth][node]
        e_low, e_high = book.low[against], book.high[against]
        gap = np.maximum(np.maximum(e_low - high, low - e_high), 0)
        span = np.maximum(np.abs(high - e_low), np.abs(e_high - low))
        nearest, furthest = (gap * gap).sum(axis=1), (span * span).sum(axis=1)
        new = np.concatenate([[True], node[1:] != node[:-1]])
        group, begin = np.cumsum(new) - 1, np.flatnonzero(new)
        keep = nearest <= np.minimum.reduceat(furthest, begin)[group]
        left = np.bincount(group[keep], minlength=len(begin))
        single = keep & (left[group] == 1) & (book.entry[against] >= 0)
        edges = bounds(n, depth)
        for at, e in zip(node[single].tolist(), book.entry[against[single]].tolist()):
            out[edges[at] : edges[at + 1]] = e
        won = book.entry[against[single]]
        np.add.at(sums, won, tree.total[depth][node[single]])
        np.add.at(counts, won, np.diff(edges)[node[single]])
        node, against = node[keep & ~single], against[keep & ~single]
        if not len(node):
            break
        inner = book.entry[against] < 0
        if depth == tree.depth and not inner.any():
            settle(tree.points, book, node, against, edges, out, sums, counts)
            break
        # both trees go down a level; an entry, or a leaf of parts, stays as it is
        against = np.where(inner, book.first[against], against), np.where(inner, book.second[against], -1)
        node, against = np.repeat(node, 2), np.stack(against, axis=1).ravel()
        node, against = node[against >= 0], against[against >= 0]
        if depth < tree.depth:
            node, against, depth = np.concatenate([2 * node, 2 * node + 1]), np.tile(against, 2), depth + 1
            by = np.argsort(node, kind="stable")
            node, against = node[by], against[by]
    return out, sums, counts


def settle(points, book: EntryTree, node, against, edges, out, sums, counts) -> None:
    """Nearest of the entries that are left, for every point of the leaves that are left."""
    new = np.concatenate([[True], node[1:] != node[:-1]])
    leaves, begin = node[new], np.flatnonzero(new)
    choices = np.diff(np.append(begin, len(node)))
    size = edges[leaves + 1] - edges[leaves]
    point = np.repeat(edges[leaves] - np.cumsum(size) + size, size) + np.arange(size.sum())
    many = np.repeat(choices, size)
    first = np.cumsum(many) - many
    which = np.repeat(np.repeat(begin, size) - first, many) + np.arange(many.sum())
    entry = book.entry[against[which]]
    apart = points[np.repeat(point, many)] - book.entries[entry]
    distance = (apart * apart).sum(axis=1)
    least = np.repeat(np.minimum.reduceat(distance, first), many)
    best = np.minimum.reduceat(np.where(distance == least, entry, len(book.entries)), first)
    out[point] = best
    np.add.at(sums, best, points[point])
    np.add.at(counts, best, 1)


def whole(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, label) of the rows whose vector has numbers only."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    return rows.where(F.col("embedding").isNotNull() & fine)


@dataclass(frozen=True)
class Shape:
    """Components of a vector, parts, and the components of a part."""

    length: int
    parts: int
    width: int


def integers(embedding: pa.Array, shape: Shape, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows can be coded, and their integers as (row, part, component)."""
    sizes = embedding.value_lengths().to_numpy(zero_copy_only=False)
    fits = sizes == shape.length
    values = embedding.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).reshape(-1, shape.length)
    values = np.floor(values * scale)
    near = (np.abs(values) <= reach(shape.width)).all(axis=1)
    fits[fits] = near
    out = np.zeros((int(near.sum()), shape.parts * shape.width), np.int64)
    out[:, : shape.length] = values[near]
    return fits, out.reshape(-1, shape.parts, shape.width)


def blocks(rows: DataFrame, shape: Shape, scale: int) -> DataFrame:
    """One row per block: its vec_ids, labels, and for each part the order of its tree and the integers in it."""
    fields = [StructField("vec_ids", ArrayType(rows.schema["vec_id"].dataType)), StructField("labels", ArrayType(rows.schema["label"].dataType))]
    schema = StructType([*fields, StructField("order", BinaryType()), StructField("points", BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = [], [], []

        def block() -> pa.RecordBatch:
            data = np.concatenate(vectors)
            order, points = [], []
            for p in range(shape.parts):
                by, _ = halved(data[:, p], LEAF)
                order.append(by.astype(np.uint16))
                points.append(data[by, p].astype(np.int32))
            row = {"vec_ids": ids, "labels": labels, "order": np.stack(order).tobytes(), "points": np.stack(points).tobytes()}
            return pa.RecordBatch.from_pylist([row], arrow)

        for b in (x.slice(k, BLOCK) for x in batches for k in range(0, x.num_rows, BLOCK)):
            fits, values = integers(b.column(1), shape, scale)
            own = b.filter(pa.array(fits))
            own_ids, own_labels = own.column(0).to_pylist(), own.column(2).to_pylist()
            while len(values):
                room = BLOCK - len(ids)
                ids += own_ids[:room]
                labels += own_labels[:room]
                vectors.append(values[:room])
                own_ids, own_labels, values = own_ids[room:], own_labels[room:], values[room:]
                if len(ids) == BLOCK:
                    yield block()
                    ids, labels, vectors = [], [], []
        if ids:
            yield block()

    return rows.mapInArrow(run, schema)


def _trees(row: dict, shape: Shape) -> Iterator[tuple[int, np.ndarray, PartTree]]:
    n = len(row["vec_ids"])
    order = np.frombuffer(row["order"], np.uint16).reshape(shape.parts, n)
    points = np.frombuffer(row["points"], np.int32).reshape(shape.parts, n, shape.width).astype(np.int64)
    depth = 0
    while n >> depth > LEAF:
        depth += 1
    for p in range(shape.parts):
        yield p, order[p], PartTree.over(points[p], depth)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]


def step(stored: DataFrame, books: np.ndarray, shape: Shape) -> np.ndarray:
    """The codebooks after one round: (part, entry, component)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [EntryTree.over(b) for b in books]
        sums, counts, seen = np.zeros_like(books), np.zeros(books.shape[:2], np.int64), False
        for row in _rows_of(batches):
            seen = True
            for p, _, tree in _trees(row, shape):
                _, s, c = assigned(tree, trees[p])
                sums[p] += s
                counts[p] += c
        part, entry = np.nonzero(counts)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))],
                names=["part", "entry", "n", "sums"])

    sent = stored.mapInArrow(run, "part int, entry int, n long, sums array<long>")
    each = sent.select("part", "entry", "n", F.posexplode("sums").alias("at", "value"))
    new = books.copy()
    for r in each.groupBy("part", "entry", "at").agg(F.sum("value").alias("value"), F.sum("n").alias("n")).collect():  # one row a component of the codebooks
        new[r["part"], r["entry"], r["at"]] = r["value"] // r["n"]
    return new


def coded(stored: DataFrame, books: np.ndarray, shape: Shape, like: StructType) -> DataFrame:
    """(vec_id, label, code, error) of every vector in the blocks."""
    schema = StructType([like["vec_id"], like["label"], StructField("code", StringType()), StructField("error", LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [EntryTree.over(b) for b in books]
        for row in _rows_of(batches):
            n = len(row["vec_ids"])
            codes, error = np.zeros((n, shape.parts), np.uint8), np.zeros(n, np.int64)
            for p, order, tree in _trees(row, shape):
                entry, _, _ = assigned(tree, trees[p])
                apart = tree.points - books[p][entry]
                codes[order, p] = entry
                error[order] += (apart * apart).sum(axis=1)
            digits = codes.tobytes().hex()
            code = [digits[k : k + 2 * shape.parts] for k in range(0, len(digits), 2 * shape.parts)]
            yield pa.RecordBatch.from_pydict({"vec_id": row["vec_ids"], "label": row["labels"], "code": code, "error": error}, arrow)

    return stored.mapInArrow(run, schema)


def first_vectors(rows: DataFrame, entries: int, parts: int, scale: int) -> tuple[Shape, np.ndarray] | None:
    """The shape of the table's vectors and its first codebooks: the vectors of the smallest ids."""
    by = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    one = rows.where(F.size("embedding") > 0).orderBy(*by).select(F.size("embedding").alias("n")).first()
    if one is None:
        return None
    shape = Shape(one["n"], parts, -(-one["n"] // parts))
    top = float(reach(shape.width))
    close = F.forall("embedding", lambda x: (x * scale >= -top) & (x * scale < top + 1))
    seeds = rows.where((F.size("embedding") == shape.length) & close).orderBy(*by).limit(entries)
    values = pa.array([r["embedding"] for r in seeds.select("embedding").collect()], pa.list_(pa.float64()))
    if not len(values):
        return None
    return shape, np.ascontiguousarray(integers(values, shape, scale)[1].transpose(1, 0, 2))


def compress(vectors: DataFrame, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every kept vector, and the final codebooks (part, entry, component)."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    rows = whole(vectors)
    begun = first_vectors(rows, entries, parts, scale)
    if begun is None:
        empty = rows.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty, np.zeros((parts, 0, 0), np.int64)
    shape, books = begun
    stored = Scratch(vectors.sparkSession, "codes").save(blocks(rows, shape, scale))
    for _ in range(rounds):
        books = step(stored, books, shape)
    return coded(stored, books, shape, rows.schema), books


def decompress(codes: DataFrame, books: np.ndarray, length: int, scale: int = SCALE) -> DataFrame:
    """``codes`` with ``approximation``: the vector of the middles of its entries' integer steps."""
    codes = codes.drop("approximation")
    schema = StructType([*codes.schema, StructField("approximation", ArrayType(DoubleType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digits = np.frombuffer(bytes.fromhex("".join(b.column("code").to_pylist())), np.uint8).reshape(-1, len(books))
            values = books[np.arange(len(books)), digits].reshape(len(digits), -1)[:, :length]
            out = pa.array(list((values + 0.5) / scale), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns, out], schema=arrow)

    return codes.mapInArrow(run, schema)


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error: the error summed over all rows of the label."""
    sums = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.join(sums, codes["label"].eqNullSafe(sums["of"])).drop("of")


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def digest(vectors: DataFrame, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256)."""
    codes, books = compress(vectors, entries, parts, rounds, scale)
    codes = Scratch(vectors.sparkSession, "coded").save(codes)
    return with_label_errors(codes).select("vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))

"""Best-fit packing (operator 1): hierarchical residual packing into fixed-size sequences.

Round 0 packs every partition's pieces by best-fit decreasing. Bins that are
nearly full are final; the underfull ones become items of the next round, which
merges partitions as a tree (each task gets at most ``group_bins`` bins) and
packs again, each time with other neighbours. Rounds go on as long as they save a
sequence, or end when one group holds all underfull bins or when the bins are as
few as their tokens allow.

Bins travel as (bin, fill) pairs; pieces are only tagged with the bin of round 0
and joined once with the final place of that bin. So a task holds the lengths of
one partition or of one group of bins, never the table.

Defined cases: a null or empty text is the end token alone; a null doc_id is kept
as it is; repeated rows are packed as rows of their own; an empty table gives no
sequence.
"""

from __future__ import annotations

import bisect
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from strata.llm.common import Scratch

CAPACITY = 1024
END_ID = 2
SLACK = 8  # a bin with at most this many free places is nearly full
GROUP_BINS = 200_000  # underfull bins in one task of a merging round
SAFE_SPACE = 100_000  # white space in a run that the rank file's encoder gets; it fails at a million
SPACES = re.compile(r"\s{2,}")
_ENCODERS: dict = {}


def encoder(folder: str | None = None):
    """The public 50k byte-level BPE vocabulary, read once per Python worker.

    The rank file is the same vocabulary as ``byte_bpe_50k.json`` and gives the
    same ids about four times as fast (tests compare the two). It cannot take a
    long run of white space; ``token_ids`` has the JSON one for that.
    """
    if folder not in _ENCODERS:
        import base64

        import public_tokenizers as P
        import tiktoken

        path = os.path.join(folder, "byte_bpe_50k.tiktoken") if folder else P.path("byte_bpe_50k.tiktoken")
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _ENCODERS[folder] = tiktoken.Encoding("byte_bpe_50k", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": 50256})
    return _ENCODERS[folder]


def long_space(text: str) -> bool:
    """Whether a run of white space is longer than the rank file's pattern may back off over."""
    return len(text) > SAFE_SPACE and any(m.end() - m.start() > SAFE_SPACE for m in SPACES.finditer(text))


def token_ids(text: str, folder: str | None = None) -> list[int]:
    """Ids of ``text`` without the end token."""
    if long_space(text):
        key = ("json", folder)
        if key not in _ENCODERS:
            import public_tokenizers as P
            from tokenizers import Tokenizer

            _ENCODERS[key] = Tokenizer.from_file(os.path.join(folder, "byte_bpe_50k.json") if folder else P.path("byte_bpe_50k.json"))
        return _ENCODERS[key].encode(text, add_special_tokens=False).ids
    enc = encoder(folder)
    return enc.encode(text, allowed_special="all") if "<|endoftext|>" in text else enc.encode_ordinary(text)


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer_folder: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length and its ids as little-endian uint32 bytes.

    Only documents longer than ``capacity`` are cut; the first piece takes what
    the full ones leave.
    """
    schema = StructType([docs.schema["doc_id"], StructField("piece", IntegerType()), StructField("start", LongType()),
                         StructField("length", LongType()), StructField("ids", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, piece, start, length, body = [], [], [], [], []
            for i, text in enumerate(b.column(1)):
                text = text.as_py() or ""
                ids = [*token_ids(text, tokenizer_folder), end_id]
                data, n = np.array(ids, "<u4").tobytes(), len(ids)
                cut = n % capacity or min(n, capacity)
                at = [0, *range(cut, n + 1, capacity)]
                for k, (x, y) in enumerate(zip(at, at[1:])):
                    row.append(i)
                    piece.append(k)
                    start.append(x)
                    length.append(y - x)
                    body.append(data[4 * x : 4 * y])
                if len(row) >= 20_000:
                    yield batch(b, row, piece, start, length, body)
                    row, piece, start, length, body = [], [], [], [], []
            yield batch(b, row, piece, start, length, body)

    def batch(b, row, piece, start, length, body) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
             pa.array(length, pa.int64()), pa.array(body, pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: (bin, offset) of each item and the fill of each bin.

    Lengths are integers up to ``capacity``, so open bins are kept in one stack
    per free size; a sorted list of the sizes in use finds the tightest.
    """
    order = np.argsort(-lengths, kind="stable")
    where, offset, fill = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    open_bins: dict[int, list[int]] = {}
    sizes: list[int] = []
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        k = bisect.bisect_left(sizes, n)
        if k == len(sizes):
            bin_no, free = len(fill), capacity
            fill.append(0)
        else:
            free = sizes[k]
            stack = open_bins[free]
            bin_no = stack.pop()
            if not stack:
                del open_bins[free]
                sizes.pop(k)
        where[i], offset[i] = bin_no, fill[bin_no]
        fill[bin_no] += n
        free -= n
        if free:
            if free in open_bins:
                open_bins[free].append(bin_no)
            else:
                open_bins[free] = [bin_no]
                bisect.insort(sizes, free)
    return where, offset, np.array(fill, np.int64)


def _round(items: DataFrame, capacity: int, number: int) -> DataFrame:
    """Packs each partition of ``items`` (with a ``length``): adds bin, at (offset in the bin), fill."""
    schema = StructType(list(items.schema) + [StructField("bin", LongType()), StructField("at", LongType()), StructField("fill", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = [b for b in batches if b.num_rows]
        if not t:
            return
        t = pa.Table.from_batches(t).combine_chunks()
        bins, at, fill = best_fit(t.column("length").to_numpy(), capacity)
        # (round, partition, bin): unique, and the same again when a lost task is repeated
        base = (number << 56) + (TaskContext.get().partitionId() << 32)
        for name, x in (("bin", bins + base), ("at", at), ("fill", fill[bins])):
            t = t.append_column(name, pa.array(x))
        yield from t.to_batches(max_chunksize=50_000)

    return items.mapInArrow(run, schema)


def pack(items: DataFrame, capacity: int = CAPACITY, slack: int = SLACK, group_bins: int = GROUP_BINS) -> DataFrame:
    """``items`` (with an integer ``length`` of 1 to ``capacity``) plus sequence_id and offset."""
    scratch = Scratch(items.sparkSession, "packing")
    clash = [c for c in ("bin", "at", "fill", "sequence_id", "offset") if c in items.columns]
    placed = scratch.save(_round(scratch.save(items.drop(*clash)), capacity, 0))

    def underfull(bins: DataFrame) -> DataFrame:
        return bins.where((F.col("at") == 0) & (F.col("fill") < capacity - slack)).select(F.col("bin").alias("old"), F.col("fill").alias("length"))

    left = underfull(placed)  # one row a bin: its first piece
    moves, number = None, 0
    while True:
        n, tokens = left.agg(F.count("*"), F.sum("length")).first()
        if n < 2 or n == -(-tokens // capacity):
            break
        number += 1
        groups = -(-n // group_bins)
        merged = scratch.save(_round(left.repartition(groups, F.xxhash64("old", F.lit(number))), capacity, number))
        step = merged.select("old", "bin", F.col("at").alias("base"))
        if moves is None:
            moves = step
        else:
            m, s = moves.alias("m"), step.alias("s")
            moves = m.join(s, F.col("m.bin") == F.col("s.old"), "left").select(
                F.col("m.old").alias("old"), F.coalesce("s.bin", "m.bin").alias("bin"), (F.col("m.base") + F.coalesce("s.base", F.lit(0))).alias("base"))
        left = underfull(merged)
        now = merged.where("at = 0").count()
        if groups == 1 or now == n:
            break
    out = [F.col(c) for c in items.columns if c not in clash]
    if moves is None:
        return placed.select(*out, F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))
    moves = scratch.save(moves.withColumnRenamed("bin", "new"))
    return placed.join(moves, placed.bin == moves.old, "left").select(
        *out, F.coalesce("new", "bin").alias("sequence_id"), (F.col("at") + F.coalesce("base", F.lit(0))).alias("offset"))


def sequences(placed: DataFrame) -> DataFrame:
    """Token sequences (sequence_id, n_tokens, ids) from packed pieces that carry their ``ids``.

    A sequence is bounded by the capacity, so its pieces are gathered whole.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))

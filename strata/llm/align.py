"""Cross-tokenizer alignment (operator 11): an associative monoid of token fragments.

A text (with a space in front) is read by two vocabularies, A and B. Where tokens of
both end at the same byte, the text falls into groups; inside a group, tokens that
overlap are linked. Links are counted by (A id, B id) over the corpus, and every
document gets the sums of the counts of its links.

A byte range of a text yields a ``Fragment``: an open prefix (tokens before the first
common end), closed groups, and an open suffix (tokens after the last one). Ranges are
cut for A and for B at their own certain cuts (``vocab.Cutter``), so the two need not
meet at the edge of a range; the open parts say what is still to be matched.
``composed`` joins two neighbours and closes the groups between them. It is
associative, so the fragments of a long document are made by many tasks and joined by
a tree of rounds, ``FAN`` neighbours at a time; only open parts travel.

A text of one range is the same with nothing left open. There, words between cuts that
are certain for both vocabularies are aligned once a worker and looked up after that.

Counting. Texts are gathered into blocks of about a million words. A block holds its
distinct words, their links and its distinct id pairs with their counts; only these
pairs are shuffled to be summed, and the sums come back to the block by a join on the
pair. So a frequent pair weighs once a block, not once an occurrence.

Defined cases: null and empty texts, and texts of which the joined bytes of A's or B's
tokens differ from space + text (a U+2581 in the text), have no tokens, all numbers 0
and groups ''; they add to no count. Repeated rows are documents of their own. A null
doc_id is kept. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from strata.llm.common import Scratch
from strata.llm.vocab import ByteLevel, Known, Pieces

RANGE = 1 << 18  # bytes of a text aligned by one task
FAN = 16  # fragments joined by one row of a round
BLOCK_WORDS = 1 << 20
BLOCK_DISTINCT = 150_000
DOC, BLOCK, BYTES, FRAGMENT, TEXT, PART, DONE = range(7)  # kinds of rows
LOW = (1 << 32) - 1
_ALIGNERS: dict = {}


def linked(a: list[int], a_sizes: list[int], b: list[int], b_sizes: list[int]) -> tuple[str, int, list[int]]:
    """Groups as text, their number, and one number (A id, B id) for each link, of tokens that start and end together."""
    if not a:
        return "", 0, []
    if len(a) == len(b) == 1:
        return f"{a[0]}|{b[0]}", 1, [a[0] << 32 | b[0]]
    links, text = [], []
    others, other_sizes = iter(b), iter(b_sizes)
    y, y_end, end, a_ids, b_ids = next(others), next(other_sizes), 0, "", ""
    b_ids = str(y)
    for x, size in zip(a, a_sizes):
        end += size
        a_ids = f"{a_ids},{x}" if a_ids else str(x)
        while y_end < end:
            links.append(x << 32 | y)
            y, y_end = next(others), y_end + next(other_sizes)
            b_ids = f"{b_ids},{y}" if b_ids else str(y)
        links.append(x << 32 | y)
        if y_end == end:
            text.append(f"{a_ids}|{b_ids}")
            a_ids = b_ids = ""
            y = next(others, None)
            if y is not None:
                y_end += next(other_sizes)
                b_ids = str(y)
    return ";".join(text), len(text), links


@dataclass
class Run:
    """Neighbouring tokens of both vocabularies; each side starts at its own byte."""

    a_at: int
    a: np.ndarray
    b_at: int
    b: np.ndarray

    def joined(self, other: Run) -> Run:
        return Run(self.a_at, np.concatenate([self.a, other.a]), self.b_at, np.concatenate([self.b, other.b]))


@dataclass
class Fragment:
    """What is open at both ends of a byte range. Without a common end (``cut``) all its tokens are in ``prefix``."""

    cut: bool
    prefix: Run
    suffix: Run


class Aligner:
    """The two vocabularies and what is known of their words, once a worker."""

    def __init__(self, folder: str | None):
        self.a, self.b = ByteLevel(folder, plain=True), Pieces(folder)
        self.cutter = self.a.cutter.both(self.b.cutter)
        self.words = Known(self._words)

    def _words(self, new: list[bytes]) -> list[tuple]:
        """((n_a, n_b, n_groups, n_links), groups, links) of each word; no tokens where B's bytes differ from it.

        A byte-level vocabulary always gives back the bytes it has read.
        """
        a_tokens, b_tokens, out = self.a.tokens, self.b.tokens, []
        for word, a, b in zip(new, self.a.ids_of(new), self.b.ids_of(new)):
            pieces = [b_tokens[i] for i in b]
            if b"".join(pieces) != word:
                out.append(((0, 0, 0, 0), "", []))
                continue
            text, n, links = linked(a, [len(a_tokens[i]) for i in a], b, list(map(len, pieces)))
            out.append(((len(a), len(b), n, len(links)), text, links))
        return out

    def tokens(self, vocab, body: bytes) -> np.ndarray | None:
        """Ids of a byte range that starts and ends at certain cuts; None where their bytes differ from it."""
        ids = np.frombuffer(b"".join(b"".join(vocab.packed(f)) for f in vocab.cutter.blocks(body)), "<u4").astype(np.int64)
        return ids if b"".join([vocab.tokens[i] for i in ids.tolist()]) == body else None

    def ends(self, run: Run) -> tuple[np.ndarray, np.ndarray]:
        return run.a_at + np.cumsum(self.a.sizes[run.a]), run.b_at + np.cumsum(self.b.sizes[run.b])

    def split(self, run: Run, at: int) -> tuple[Run, Run]:
        """The tokens up to a common end and those after it."""
        i, j = (int(np.searchsorted(e, at, side="right")) for e in self.ends(run))
        return Run(run.a_at, run.a[:i], run.b_at, run.b[:j]), Run(at, run.a[i:], at, run.b[j:])

    def composed(self, left: Fragment, right: Fragment, closed: list[Run]) -> Fragment:
        """Both ranges as one; the groups that close between them are added to ``closed``."""
        middle = (left.suffix if left.cut else left.prefix).joined(right.prefix)
        common = np.intersect1d(*self.ends(middle), assume_unique=True)
        if not len(common):
            if left.cut:
                return Fragment(True, left.prefix, middle)
            return Fragment(right.cut, middle, right.suffix)
        prefix = left.prefix
        if not left.cut:
            prefix, middle = self.split(middle, int(common[0]))
        inner, rest = self.split(middle, int(common[-1]))
        if len(inner.a):
            closed.append(inner)
        return Fragment(True, prefix, right.suffix if right.cut else rest)

    def fragment(self, k: int, a_at: int, a: np.ndarray, b_at: int, b: np.ndarray, closed: list[Run]) -> Fragment:
        """The fragment of range ``k``; the first one starts at a common end, byte 0."""
        none = Run(0, np.zeros(0, np.int64), 0, np.zeros(0, np.int64))
        start = Fragment(k == 0, none, none) if k == 0 else Fragment(False, Run(a_at, none.a, b_at, none.b), none)
        return self.composed(start, Fragment(False, Run(a_at, a, b_at, b), none), closed)


def aligner(folder: str | None) -> Aligner:
    if folder not in _ALIGNERS:
        _ALIGNERS[folder] = Aligner(folder)
    return _ALIGNERS[folder]


class Block:
    """Words and documents gathered until they are worth a row."""

    def __init__(self, number: int):
        self.number, self.index = number, {}
        self.sizes = np.zeros((1024, 4), np.int64)  # n_a, n_b, n_groups, n_links of each word
        self.texts: list[str] = []
        self.links: list[list[int]] = []
        self.rows: list[dict] = []
        self.words: list[np.ndarray] = []
        self.n = 0

    def add(self, known: Known, fragments: list[bytes], row: dict, keep_text: bool) -> bool:
        """Adds a document of these words; False if a word has no tokens."""
        at = list(map(self.index.get, fragments))
        if None in at:
            missing = [i for i, x in enumerate(at) if x is None]
            new = list(dict.fromkeys([fragments[i] for i in missing]))
            for f, (sizes, text, links) in zip(new, known.of(new)):
                self._word(f, sizes, text, links)
            for i in missing:
                at[i] = self.index[fragments[i]]
        words = np.array(at, np.uint32)
        sizes = self.sizes[words]
        if not sizes[:, 0].all():
            return False
        groups = ";".join(map(self.texts.__getitem__, at))
        row["sha"] = hashlib.sha256(groups.encode()).hexdigest()
        if keep_text:
            row["text"] = groups
        row["n_a"], row["n_b"], row["n_groups"], row["n_links"] = sizes.sum(axis=0).tolist()
        self._document(words, row)
        return True

    def add_run(self, owner: Aligner, run: Run, row: dict) -> str:
        """Adds a closed run of a long document, each distinct id pair being a word; returns its groups."""
        a, b = run.a.tolist(), run.b.tolist()
        text, n, links = linked(a, owner.a.sizes[run.a].tolist(), b, owner.b.sizes[run.b].tolist())
        row["n_a"], row["n_b"], row["n_groups"], row["n_links"] = len(a), len(b), n, len(links)
        for link in dict.fromkeys(links):
            if link not in self.index:
                self._word(link, (1, 1, 1, 1), "", [link])
        self._document(np.array([self.index[x] for x in links], np.uint32), row)
        return text

    def _word(self, key, sizes: tuple[int, int, int, int], text: str, links: list[int]) -> None:
        k = len(self.texts)
        if k == len(self.sizes):
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        self.index[key], self.sizes[k] = k, sizes
        self.texts.append(text)
        self.links.append(links)

    def _document(self, words: np.ndarray, row: dict) -> None:
        row["words"], row["block"] = words.tobytes(), self.number
        self.rows.append(row)
        self.words.append(words)
        self.n += len(words)

    def full(self) -> bool:
        return self.n >= BLOCK_WORDS or len(self.texts) >= BLOCK_DISTINCT

    def closed(self, **more) -> list[dict]:
        """The rows of the documents, and one of the block's pairs."""
        if not self.rows:
            return []
        lengths = self.sizes[: len(self.links), 3]
        times = np.bincount(np.concatenate(self.words), minlength=len(lengths))
        pairs, at = np.unique(np.fromiter(chain.from_iterable(self.links), np.int64), return_inverse=True)
        counts = np.bincount(at, weights=np.repeat(times, lengths), minlength=len(pairs)).astype(np.int64)
        head = {"kind": BLOCK, "block": self.number, "pairs": pairs, "counts": counts,
                "lengths": lengths.astype(np.int32).tobytes(), "links": at.astype(np.uint32).tobytes()}
        return [head | more, *self.rows]


def _rows_schema(doc_id: StructField) -> StructType:
    kinds = {"kind": IntegerType(), "block": LongType(), "row_key": LongType(), "k": IntegerType(), "at": LongType()}
    kinds |= dict.fromkeys(["n_a", "n_b", "n_groups", "n_links"], LongType()) | {"sha": StringType(), "text": StringType(), "words": BinaryType()}
    kinds |= {"pairs": ArrayType(LongType()), "counts": ArrayType(LongType()), "lengths": BinaryType(), "links": BinaryType()}
    kinds |= {"ok": BooleanType(), "cut": BooleanType()}
    for part in ("prefix", "suffix"):
        kinds |= {f"{part}_a_at": LongType(), f"{part}_a": BinaryType(), f"{part}_b_at": LongType(), f"{part}_b": BinaryType()}
    return StructType([StructField(doc_id.name, doc_id.dataType), *[StructField(c, t) for c, t in kinds.items()]])


def _batches(rows: list[dict], schema: pa.Schema, step: int = 5_000) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(rows), step):
        yield pa.RecordBatch.from_pylist(rows[k : k + step], schema)


def _first_block(stage: int) -> int:
    """Block numbers: (stage, partition, running number); the same again when a lost task is repeated."""
    return (stage << 56) + (TaskContext.get().partitionId() << 30)


def read(docs: DataFrame, folder: str | None, keep_text: bool, size: int) -> DataFrame:
    """Documents of one range, aligned, with their blocks; the byte ranges of longer ones."""
    docs = docs.select("doc_id", "text")
    schema = _rows_schema(docs.schema["doc_id"])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = aligner(folder), _first_block(0)
        block, done, key = Block(number), [], _first_block(0)
        for b in (x.slice(k, 256) for x in batches for k in range(0, x.num_rows, 256)):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                key += 1
                body = b" " + (text.as_py() or "").encode()
                if len(body) == 1:
                    done.append({"kind": DONE, "doc_id": doc_id})
                elif len(body) > size:
                    for row in ranges(own, body, size):
                        yield from _batches([row | {"kind": BYTES, "doc_id": doc_id, "row_key": key}], arrow)
                else:
                    fragments = [f for part in own.cutter.blocks(body) for f in part]
                    if not block.add(own.words, fragments, {"kind": DOC, "doc_id": doc_id, "row_key": key}, keep_text):
                        done.append({"kind": DONE, "doc_id": doc_id})
                if block.full():
                    yield from _batches(block.closed(), arrow)
                    number += 1
                    block = Block(number)
            yield from _batches(done, arrow)
            done = []
        yield from _batches(block.closed(), arrow)

    return docs.mapInArrow(run, schema)


def ranges(own: Aligner, body: bytes, size: int) -> Iterator[dict]:
    """The byte ranges of a text: about ``size`` bytes, cut for each vocabulary where it is certain."""
    a_at = b_at = k = 0
    while a_at < len(body) or b_at < len(body):
        a_end, b_end = (v.cutter.next_cut(body, (k + 1) * size) for v in (own.a, own.b))
        a_end, b_end = max(a_at, a_end), max(b_at, b_end)
        yield {"k": k, "prefix_a_at": a_at, "prefix_a": body[a_at:a_end], "prefix_b_at": b_at, "prefix_b": body[b_at:b_end]}
        a_at, b_at, k = a_end, b_end, k + 1


def _stored(x: Fragment) -> dict:
    row: dict = {"cut": x.cut}
    for part in ("prefix", "suffix"):
        r = getattr(x, part)
        row |= {f"{part}_a_at": r.a_at, f"{part}_a": r.a.astype("<u4").tobytes(), f"{part}_b_at": r.b_at, f"{part}_b": r.b.astype("<u4").tobytes()}
    return row


def _loaded(row: dict) -> Fragment:
    ids = lambda body: np.frombuffer(body, "<u4").astype(np.int64)
    runs = [Run(row[f"{p}_a_at"], ids(row[f"{p}_a"]), row[f"{p}_b_at"], ids(row[f"{p}_b"])) for p in ("prefix", "suffix")]
    return Fragment(row["cut"], *runs)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for k in range(0, b.num_rows, 4):
            yield from b.slice(k, 4).to_pylist()


def _closed_rows(own: Aligner, key: int, closed: list[Run], number: int) -> list[dict]:
    """Closed runs of a long document: their groups in order of their place, and a block of their pairs."""
    block, out = Block(number), []
    for r in closed:
        text = block.add_run(own, r, {"kind": PART, "row_key": key})
        out.append({"kind": TEXT, "row_key": key, "at": r.a_at, "text": text})
    return out + block.closed(row_key=key)


def fragments(parts: DataFrame, folder: str | None) -> DataFrame:
    """The fragment of each byte range, and what it closes."""
    arrow = to_arrow_schema(parts.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = aligner(folder), _first_block(1)
        for row in _rows_of(batches):
            a, b = own.tokens(own.a, row["prefix_a"]), own.tokens(own.b, row["prefix_b"])
            closed: list[Run] = []
            ok = a is not None and b is not None
            none = np.zeros(0, np.int64)
            found = own.fragment(row["k"], row["prefix_a_at"], a if ok else none, row["prefix_b_at"], b if ok else none, closed)
            out = [{"kind": FRAGMENT, "row_key": row["row_key"], "k": row["k"], "ok": ok} | _stored(found)]
            yield from _batches(out + _closed_rows(own, row["row_key"], closed, number), arrow)
            number += 1

    return parts.repartition("row_key", "k").mapInArrow(run, parts.schema)


def joined_round(rows: DataFrame, folder: str | None, stage: int) -> DataFrame:
    """One round of the tree: ``FAN`` neighbouring fragments become one, in a stream sorted by their place."""
    arrow = to_arrow_schema(rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number, held, at, closed = aligner(folder), _first_block(stage), None, None, []

        def sent() -> Iterator[pa.RecordBatch]:
            if held is not None:
                out = [{"kind": FRAGMENT, "row_key": at[0], "k": at[1], "ok": True} | _stored(held)]
                yield from _batches(out + _closed_rows(own, at[0], closed, number), arrow)

        for row in _rows_of(batches):
            place, one = (row["row_key"], row["k"] // FAN), _loaded(row)
            if place == at:
                held = own.composed(held, one, closed)
            else:
                yield from sent()
                held, at, closed, number = one, place, [], number + 1
        yield from sent()

    near = rows.repartition("row_key", F.expr(f"k div {FAN}")).sortWithinPartitions("row_key", "k")
    return near.mapInArrow(run, rows.schema)


def groups_in_order(texts: DataFrame) -> DataFrame:
    """(row_key, sha): SHA-256 of a long document's groups, which stream by in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for b in batches:
            keys, shas = [], []
            for k, text in zip(b.column(0).to_pylist(), b.column(2)):
                if k != key:
                    if sha is not None:
                        keys.append(key)
                        shas.append(sha.hexdigest())
                    key, sha = k, hashlib.sha256()
                else:
                    sha.update(b";")
                sha.update(text.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(shas, pa.string())], names=["row_key", "sha"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([sha.hexdigest()])], names=["row_key", "sha"])

    return texts.select("row_key", "at", "text").repartition("row_key").sortWithinPartitions("row_key", "at").mapInArrow(run, "row_key long, sha string")


NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def scored(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Documents and parts with n_best and count_sum: each block meets the counts of its own pairs."""
    carried = ["kind", "row_key", "doc_id", "sha", "text", "n_a", "n_b", "n_groups", "n_links"]
    schema = StructType([*[rows.schema[c] for c in carried], StructField("n_best", LongType()), StructField("count_sum", LongType())])
    arrow = to_arrow_schema(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        is_head = left.column("kind").to_numpy() == BLOCK
        head = left.filter(pa.array(is_head)).slice(0, 1).to_pylist()[0]
        docs = left.filter(pa.array(~is_head))
        pairs, weights = np.array(head["pairs"], np.int64), np.zeros((2, len(head["pairs"])), np.int64)
        at = np.searchsorted(pairs, right.column("pair").to_numpy())
        weights[0, at] = right.column("best").to_numpy().astype(np.int64)
        weights[1, at] = right.column("count").to_numpy()
        lengths, link = np.frombuffer(head["lengths"], "<i4"), np.frombuffer(head["links"], "<u4")
        edges = np.concatenate([[0], np.cumsum(lengths)])
        summed = [np.diff(np.concatenate([[0], np.cumsum(w[link])])[edges]) for w in weights]
        bodies = docs.column("words").to_pylist()
        words = np.frombuffer(b"".join(bodies), "<u4")
        ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in bodies])])
        sums = [np.diff(np.concatenate([[0], np.cumsum(s[words])])[ends]) for s in summed]
        columns = [docs.column(c).combine_chunks() for c in carried] + [pa.array(s, pa.int64()) for s in sums]
        return pa.Table.from_arrays(columns, schema=arrow)

    pairs = rows.where(F.col("kind") == BLOCK).select(F.col("block").alias("asked"), F.explode("pairs").alias("pair")).join(counts, "pair")
    left = rows.where(F.col("block").isNotNull()).select("block", *carried, "words", "pairs", "lengths", "links")
    return left.groupBy("block").cogroup(pairs.select("asked", "pair", "count", "best").groupBy("asked")).applyInArrow(run, schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, count) over all blocks."""
    pairs = rows.where(F.col("kind") == BLOCK).select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    return pairs.where("p.counts > 0").groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("count"))


def align(docs: DataFrame, folder: str | None = None, keep_groups: bool = False, size: int = RANGE) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, numbers, groups_sha256, and ``groups`` if kept) and id pairs (a, b, count, best)."""
    scratch = Scratch(docs.sparkSession, "align")
    first = scratch.save(read(docs, folder, keep_groups, size))
    ranges_ = first.where(F.col("kind") == BYTES)
    found = scratch.save(fragments(ranges_, folder))
    closed, open_ = [found], found.where(F.col("kind") == FRAGMENT)
    bad = open_.where("NOT ok").select("row_key").distinct()
    last, stage = open_.agg(F.max("k")).first()[0] or 0, 2
    while last:
        joined = scratch.save(joined_round(open_, folder, stage))
        closed.append(joined)
        open_, last, stage = joined.where(F.col("kind") == FRAGMENT), last // FAN, stage + 1
    pieces = closed[0]
    for more in closed[1:]:
        pieces = pieces.unionByName(more)
    pieces = pieces.where(F.col("kind") != FRAGMENT).join(bad, "row_key", "left_anti").select(*first.columns)
    rows = first.where(F.col("kind").isin(DOC, BLOCK)).unionByName(pieces)

    sums = scratch.save(pair_counts(rows)).withColumn("b", F.col("pair").bitwiseAND(F.lit(LOW)))
    top = sums.groupBy("b").agg(F.max("count").alias("top"))
    counts = scratch.save(sums.join(top, "b").select("pair", "count", (F.col("count") == F.col("top")).alias("best")))
    out = scratch.save(scored(rows, counts))

    texts = pieces.where(F.col("kind") == TEXT)
    own = out.where(F.col("kind") == PART).groupBy("row_key").agg(*[F.sum(c).alias(c) for c in NUMBERS])
    long_ = ranges_.where("k = 0").select("row_key", "doc_id").join(own, "row_key", "left").join(groups_in_order(texts), "row_key", "left")
    if keep_groups:
        parts = F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda p: p["text"])
        long_ = long_.join(texts.groupBy("row_key").agg(F.array_join(parts, ";").alias("text")), "row_key", "left")
    else:
        long_ = long_.withColumn("text", F.lit(None).cast("string"))
    nothing = first.where(F.col("kind") == DONE).select("doc_id", "sha", "text", *[F.lit(0).cast("long").alias(c) for c in NUMBERS])
    every = out.where(F.col("kind") == DOC).select("doc_id", "sha", "text", *NUMBERS).unionByName(long_.select("doc_id", "sha", "text", *NUMBERS)).unionByName(nothing)
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in NUMBERS]
    kept = [F.coalesce("text", F.lit("")).alias("groups")] if keep_groups else []
    documents = every.select("doc_id", *numbers, F.coalesce("sha", F.lit("")).alias("groups_sha256"), *kept)
    ids = counts.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(F.lit(LOW)).alias("b"), "count", "best")
    return documents, ids

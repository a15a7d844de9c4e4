"""Substring dedup (operator 4): prefix-partitioned suffix trees over words.

Removes every word covered by a window of 35 words that also starts anywhere else.

The suffixes that can repeat (see ``repeats``) are partitioned by prefixes of
variable length: first by the words at their anchor, and where a group would not
fit into memory by longer ones, up to the whole window. Each group's subtree is
built in memory: its suffixes are sorted, neighbours' common prefixes taken, and
the internal nodes read off as the intervals of the sorted order that share a
prefix. The leaves below a node of depth 35 or more are the repeats; runs of
such suffixes in one text form the maximal ones.

Defined cases: a null or empty text has no words; rows with the same text are
copies, so all of a text of 35 words or more goes; a text may repeat within
itself; texts that differ in white space only are different texts with the same
windows; extra columns pass through untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch, text_keys
from strata.llm.repeats import CHANGED, SPAN_LIST, Kind, Shard, applied, changed_texts, digested, union_spans, without

WINDOW = 35
GRAM = 12


def name_prefixes(ids: np.ndarray, window: int) -> list[tuple[int, np.ndarray]]:
    """(length, rank of the prefix of that length of every suffix), lengths doubling up to ``window``.

    Ranks follow the order of the words, so they sort and compare like the prefixes.
    """
    out, length = [(1, ids)], 1
    while 2 * length <= window:
        r = out[-1][1]
        nxt = np.concatenate([r[length:], np.zeros(min(length, len(r)), np.int64)])
        r = np.unique(r * (int(r.max()) + 1) + nxt, return_inverse=True)[1].astype(np.int64)
        length *= 2
        out.append((length, r))
    return out


def common_prefix(ranks: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray, window: int) -> np.ndarray:
    """Words that suffixes ``a`` and ``b`` share, up to ``window``."""
    same = np.zeros(len(a), np.int64)
    for length, r in reversed(ranks):
        can = same + length <= window
        more = can & (r[np.where(can, a + same, 0)] == r[np.where(can, b + same, 0)])
        same += length * more
    return same


def deep_leaves(prefix: np.ndarray, depth: int) -> np.ndarray:
    """Which sorted suffixes hang below an internal node of at least ``depth``.

    ``prefix[i]``: what suffix i shares with the one before. The internal nodes
    of depth ``depth`` or more are the maximal intervals without a smaller value.
    """
    deep = prefix >= depth
    leaf = deep.copy()
    leaf[:-1] |= deep[1:]
    return leaf


def subtrees(s: Shard, kind: Kind) -> list[np.ndarray]:
    """For each span of the shard, which of its windows repeat."""
    words = [b.split() for b in s.bodies]
    numbers = {w: i for i, w in enumerate(sorted(set().union(*words)))}
    size = np.array([len(w) for w in words])
    ids = np.fromiter((numbers[w] for ws in words for w in ws), np.int64, int(size.sum()))
    start, n, group = np.cumsum(size) - size, np.array(s.n), np.array(s.group)
    first = np.cumsum(n) - n
    suffix = np.arange(int(n.sum())) + np.repeat(start - first, n)
    owner = np.repeat(group, n)
    ranks = name_prefixes(ids, kind.window)
    top, r = ranks[-1]
    rest = kind.window - top  # the whole window: the longest named prefix, then one that ends with the window
    order = np.lexsort((r[suffix + rest], r[suffix], owner))
    a, b = suffix[order[:-1]], suffix[order[1:]]
    prefix = np.concatenate([[-1], np.where(owner[order[1:]] == owner[order[:-1]], common_prefix(ranks, a, b, kind.window), -1)])
    hit = np.zeros(len(suffix), bool)
    hit[order] = deep_leaves(prefix, kind.window)
    return np.split(hit, first[1:])


WORDS = Kind(window=WINDOW, gram=GRAM, words=True, shard_bytes=1 << 20, group_bytes=4 << 20)
N_WORDS = "size(filter(split(coalesce(text, ''), '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w != ''))"


def changed(docs: DataFrame, kind: Kind = WORDS) -> DataFrame:
    """(k1, k2, n_removed, spans, kept): texts that lose words, by the key of their text; kept words joined by a space.

    All three are null for a text with exact copies: it goes whole if it has a window.
    """
    rows = changed_texts(docs, kind, subtrees, Scratch(docs.sparkSession, "substrings"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(k, 256) for x in batches for k in range(0, x.num_rows, 256)):
            spans, kept, removed = [], [], []
            for pairs, text in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                if pairs is None:
                    for c in (spans, kept, removed):
                        c.append(None)
                    continue
                ranges = union_spans([(p["s"], p["e"]) for p in pairs])
                spans.append([{"s": s, "e": e} for s, e in ranges])
                kept.append(b" ".join(w for part in without(text.split(), ranges) for w in part))
                removed.append(sum(e - s for s, e in ranges))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(spans, SPAN_LIST), pa.array(kept, pa.binary())],
                names=["k1", "k2", "n_removed", "spans", "kept"])

    return rows.mapInArrow(run, CHANGED)


def whole_words(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, n_words, sha): words of every text and the digest of all of them joined by a space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sha = [], []
            for t in b.column(3):
                words = (t.as_py() or b"").split()
                n.append(len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(n, pa.int64()), pa.array(sha, pa.string())],
                                             names=["doc_id", "k1", "k2", "n_words", "sha"])

    rows = docs.select("doc_id", *text_keys(F.col("text")), F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, k1 long, k2 long, n_words long, sha string")


def deduplicate(docs: DataFrame, kind: Kind = WORDS) -> DataFrame:
    """All rows of ``docs`` with n_removed, spans (word ranges) and ``kept``.

    ``kept``: the remaining words joined by a space, or the text as it is where nothing goes.
    """
    out = applied(docs, changed(docs, kind), F.expr(N_WORDS), F.coalesce("text", F.lit("")).cast("binary"), kind.window)
    return out.withColumn("kept", F.col("kept").cast("string"))


def digest(docs: DataFrame, kind: Kind = WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256). Texts do not travel: only their keys and digests do."""
    return digested(whole_words(docs), changed(docs, kind), "n_words", kind.window).select("doc_id", "n_words", "n_removed", "kept_sha256")

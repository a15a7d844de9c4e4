"""Suffix-array dedup (operator 8): external induced sorting of byte suffixes.

Removes every byte covered by a 400-byte string that also starts anywhere else.

The sampled suffixes are those at the anchors of ``repeats``; they are sorted by
their bytes once, with the common-prefix value of each neighbouring pair. All
other suffixes are induced: step by step, the suffixes one byte further left are
put in order by the tuple (their first byte, the rank of the suffix to their
right), and their common-prefix value is one more than the smallest value between
the two ranks. A window repeats where its suffix shares 400 bytes with a
neighbour.

External: the suffix tuples of the corpus are queued by group in Spark's sort
shuffle, which spills sorted runs to disk and merges them; a task induces one
shard at a time, and a group that does not fit goes back to the queue under a
longer prefix, recursively. So a shard is bounded whatever the corpus holds.

Defined cases: null and empty texts have no bytes and nothing to remove; rows with
the same text are copies of each other, so all of a text of 400 bytes or more goes;
a text may repeat within itself; extra columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch, text_keys
from strata.llm.repeats import CHANGED, SPAN_LIST, Kind, Shard, applied, changed_texts, digested, union_spans, without

WINDOW = 400
GRAM = 200
APART = -(1 << 30)  # common-prefix value across groups: never grows to a window


def sampled_order(s: Shard, flat: np.ndarray, start: np.ndarray, size: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans in the order of the suffixes at their anchors, and the common prefix of each with the one before."""
    left, group = np.array(s.left), np.array(s.group, ">u4")
    right = np.minimum(size - left, window)
    keys = np.zeros((len(left), 4 + window), np.uint8)
    keys[:, :4] = group.view(np.uint8).reshape(-1, 4)
    for k in range(0, len(left), 4096):
        at = (start + left)[k : k + 4096, None] + np.arange(window)
        inside = np.arange(window) < right[k : k + 4096, None]
        keys[k : k + 4096, 4:] = np.where(inside, flat[np.minimum(at, len(flat) - 1)], 0)
    order = np.argsort(keys.view(f"S{4 + window}").ravel(), kind="stable")
    prefix = np.full(len(left), APART, np.int64)
    for k in range(1, len(left), 4096):
        a, b = order[k - 1 : k + 4095], order[k : k + 4096]
        a = a[: len(b)]
        differ = keys[a] != keys[b]
        n = np.where(differ.any(axis=1), differ.argmax(axis=1), 4 + window)
        n = np.where(n < 4, APART, np.minimum(n - 4, np.minimum(right[a], right[b])))
        prefix[k : k + len(b)] = n
    return order, prefix


def induced(s: Shard, kind: Kind) -> list[np.ndarray]:
    """For each span of the shard, which of its windows repeat."""
    flat = np.frombuffer(b"".join(s.bodies), np.uint8)
    size = np.array([len(b) for b in s.bodies])
    start = np.cumsum(size) - size
    left, n, group = np.array(s.left), np.array(s.n), np.array(s.group)
    hit = np.zeros(int(n.sum()), bool)
    first = np.cumsum(n) - n
    order, prefix = sampled_order(s, flat, start, size, kind.window)
    for offset in range(int(left.max()) + 1):
        deep = prefix >= kind.window
        twice = deep.copy()
        twice[:-1] |= deep[1:]
        own = order[twice]
        window_no = left[own] - offset
        mine = window_no < n[own]
        hit[first[own[mine]] + window_no[mine]] = True
        # induce the suffixes one byte to the left
        at = np.flatnonzero(left[order] > offset)
        if not len(at):
            break
        go = order[at]
        key = group[go] * 256 + flat[start[go] + left[go] - offset - 1]
        by = np.argsort(key, kind="stable")
        old, key = at[by], key[by]
        after = np.full(len(old), APART, np.int64)
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        if len(same):
            between = np.stack([old[same - 1] + 1, old[same] + 1], axis=1).ravel()
            least = np.minimum.reduceat(np.append(prefix, APART), between)[::2]
            after[same] = least + 1
        order, prefix = go[by], after
    return np.split(hit, first[1:])


BYTES = Kind(window=WINDOW, gram=GRAM, words=False)


def to_characters(text: bytes, ranges: list[list[int]]) -> list[list[int]]:
    """Ranges widened to whole UTF-8 characters."""
    out = []
    for s, e in ranges:
        while s and text[s] & 0xC0 == 0x80:
            s -= 1
        while e < len(text) and text[e] & 0xC0 == 0x80:
            e += 1
        out.append((s, e))
    return union_spans(out)


def changed(docs: DataFrame, kind: Kind = BYTES, whole_characters: bool = False) -> DataFrame:
    """(k1, k2, n_removed, spans, kept): texts that lose bytes, by the key of their text.

    All three are null for a text with exact copies: it goes whole if it has a window.
    """
    rows = changed_texts(docs, kind, induced, Scratch(docs.sparkSession, "suffixes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(k, 256) for x in batches for k in range(0, x.num_rows, 256)):
            spans, kept, removed = [], [], []
            for pairs, text in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                if pairs is None:
                    for c in (spans, kept, removed):
                        c.append(None)
                    continue
                ranges = union_spans([(p["s"], p["e"]) for p in pairs])
                if whole_characters:
                    ranges = to_characters(text, ranges)
                spans.append([{"s": s, "e": e} for s, e in ranges])
                kept.append(b"".join(without(text, ranges)))
                removed.append(sum(e - s for s, e in ranges))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(spans, SPAN_LIST), pa.array(kept, pa.binary())],
                names=["k1", "k2", "n_removed", "spans", "kept"])

    return rows.mapInArrow(run, CHANGED)


def deduplicate(docs: DataFrame, kind: Kind = BYTES, whole_characters: bool = False) -> DataFrame:
    """All rows of ``docs`` with n_removed, spans (byte ranges) and ``kept`` (the remaining bytes).

    Cuts may fall inside a character, so ``kept`` is binary; with ``whole_characters``
    they are widened and it is valid UTF-8.
    """
    text = F.coalesce("text", F.lit(""))
    return applied(docs, changed(docs, kind, whole_characters), F.octet_length(text), text.cast("binary"), kind.window)


def digest(docs: DataFrame, kind: Kind = BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256). Texts do not travel: only their keys and digests do."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", *text_keys(F.col("text")), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha"))
    return digested(rows, changed(docs, kind), "n_bytes", kind.window).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")

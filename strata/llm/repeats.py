"""Search for windows of ``window`` tokens that start more than once in the corpus.

The shared front of operators 4 (words) and 8 (bytes); each brings its own way to
sort the suffixes of one group.

1. Sampling. Every window has one anchor: its ``gram`` tokens with the smallest
   hash, leftmost among equals. Equal windows have their anchor at the same
   offset, so a window can only repeat where its anchor's gram does. One row per
   anchor: text, anchor, and the range of window starts that own it.
2. Anchors are shuffled by gram; those whose gram starts once only are done. A gram
   that starts twice in a block of texts is known to repeat: two of its anchors go
   to the others as witnesses, and all of them pass by without that shuffle's key, so
   a gram with a third of all anchors does not land in one task.
3. The texts of the others are fetched once; every remaining anchor becomes a
   span, the tokens of its windows, and goes to the group of its gram.
4. A group holds all windows that can equal each other. Equal spans are collapsed
   as they stream by in sorted order. Groups are gathered into shards of
   ``shard_bytes`` and sorted there. A group beyond ``group_bytes`` is not
   gathered: its windows are keyed again by a longer prefix (the tokens common to
   a narrower range of offsets), up to the whole window, where groups hold equal
   spans only.

Texts are named by 128-bit keys. Exact copies are one text with a count; they are
collapsed in the map tasks, before any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch, first_per_task, mix64, text_keys

SLICE = 512  # texts unpacked at a time
BLOCK = 1 << 20  # bytes hashed at a time, so memory does not follow the length of a text
INDEX_BITS = np.uint64((1 << 24) - 1)
MULTIPLIER, INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[str, np.ndarray] = {}

SPANS = "g long, k1 long, k2 long, a long, left int, n int, level int, body binary"


@dataclass(frozen=True)
class Kind:
    """What a token is, and the sizes of the search."""

    window: int
    gram: int
    words: bool
    shard_bytes: int = 4 << 20
    group_bytes: int = 16 << 20

    @property
    def offsets(self) -> int:
        return self.window - self.gram + 1

    def width(self, level: int) -> int:
        """Offsets that share a group at this level: all, then an eighth of it each time, down to one."""
        w = self.offsets
        for _ in range(level):
            w = max(1, -(-w // 8))
        return w


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, BLOCK + 4096)
        for name, m in (("up", MULTIPLIER), ("down", INVERSE)):
            x = np.full(size, m, np.uint64)
            x[0] = 1
            _POWERS[name] = np.cumprod(x)
    return _POWERS["up"], _POWERS["down"]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[starts:ends]`` for each range, from one running polynomial sum."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts])


def word_bounds(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a byte array."""
    inside = np.concatenate([[False], ~SPACE[flat], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, in time that does not depend on the width."""
    n = len(v) - width + 1
    pad = -len(v) % width
    rows = np.concatenate([v, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(values: np.ndarray, lengths: np.ndarray, kind: Kind) -> tuple[np.ndarray, ...]:
    """(text, gram hash, anchor, first and last window start) over texts laid end to end.

    ``values`` are token hashes, ``lengths`` the tokens of each text; positions
    are returned from the start of each text.
    """
    empty = np.zeros(0, np.int64)
    counts = np.maximum(lengths - kind.window + 1, 0)
    total = int(counts.sum())
    if not total:
        return empty, empty, empty, empty, empty
    n = len(values) - kind.gram + 1
    at = np.arange(n)
    h = range_hashes(values, at, at + kind.gram)
    low = sliding_min((h & ~INDEX_BITS) | at.astype(np.uint64), kind.offsets)
    base = np.cumsum(lengths) - lengths
    text = np.repeat(np.arange(len(lengths)), counts)
    start = np.arange(total) - np.repeat(np.cumsum(counts) - counts - base, counts)
    anchor = (low[start] & INDEX_BITS).astype(np.int64)
    new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])) + 1
    first = np.concatenate([[0], new])
    last = np.concatenate([new - 1, [total - 1]])
    t, x = text[first], anchor[first]
    return t, h[x].view(np.int64), x - base[t], start[first] - base[t], start[last] - base[t]


def text_blocks(texts: list[bytes], kind: Kind) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(values, lengths, first text, tokens before) in blocks; a long text comes in overlapping pieces."""
    first, flat, size = 0, [], 0

    def flush(lo: int, group: list[bytes]):
        body = np.frombuffer(b"\n".join(group), np.uint8)
        sizes = np.array([len(t) for t in group], np.int64)
        base = np.cumsum(sizes + 1) - sizes - 1
        if kind.words:
            s, e = word_bounds(body)
            edge = np.searchsorted(s, np.concatenate([base, [len(body) + 1]]))
            yield range_hashes(BYTE_VALUES[body], s, e), np.diff(edge), lo, 0
        else:
            keep = np.ones(len(body), bool)
            keep[base[1:] - 1] = False
            yield BYTE_VALUES[body[keep]], sizes, lo, 0

    for i, t in enumerate(texts):
        if len(t) > BLOCK:
            if flat:
                yield from flush(first, flat)
            yield from long_text(t, i, kind)
            first, flat, size = i + 1, [], 0
            continue
        if size + len(t) > BLOCK and flat:
            yield from flush(first, flat)
            first, flat, size = i, [], 0
        flat.append(t)
        size += len(t)
    if flat:
        yield from flush(first, flat)


def long_text(t: bytes, i: int, kind: Kind) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    over = kind.window - 1
    if not kind.words:
        body = np.frombuffer(t, np.uint8)
        for s in range(0, max(1, len(body) - over), BLOCK):
            part = body[s : s + BLOCK + over]
            yield BYTE_VALUES[part], np.array([len(part)]), i, s
        return
    held, done, at = np.zeros(0, np.uint64), 0, 0
    while at < len(t):
        end = at + BLOCK
        while end < len(t) and not SPACE[t[end]]:  # cut between words
            end += 1
        body = np.frombuffer(t[at:end], np.uint8)
        s, e = word_bounds(body)
        held = np.concatenate([held, range_hashes(BYTE_VALUES[body], s, e)])
        yield held, np.array([len(held)]), i, done
        keep = min(over, len(held))
        done += len(held) - keep
        held, at = held[len(held) - keep :], end


ASKED, WITNESS, SURE = range(3)
ANCHOR = ["k1", "k2", "g", "x", "a", "b"]


def sample(texts: DataFrame, kind: Kind) -> DataFrame:
    """(k1, k2, g, x, a, b, role): the anchors of all texts; a text that comes again in a task is passed over.

    Of the anchors whose gram starts twice in a block, two go as witnesses too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for b in (x.slice(k, SLICE) for x in batches for k in range(0, x.num_rows, SLICE)):
            keys, bodies = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist())), []
            for key, t in zip(keys, b.column(2)):
                bodies.append(b"" if key in seen else t.as_py() or b"")
                seen.add(key)
            for values, lengths, first, before in text_blocks(bodies, kind):
                t, g, x, a, z = anchors(values, lengths, kind)
                if len(t):
                    order = np.argsort(g, kind="stable")
                    same = g[order][1:] == g[order][:-1]
                    again, follows = np.zeros(len(g), bool), np.concatenate([[False], same])
                    again[order] = follows | np.concatenate([same, [False]])
                    third = np.concatenate([[False, False], same[1:] & same[:-1]])[: len(g)]
                    shown = order[again[order] & ~third]
                    row = np.concatenate([np.arange(len(g)), shown])
                    role = np.concatenate([np.where(again, SURE, ASKED), np.full(len(shown), WITNESS)]).astype(np.int32)
                    text = pa.array((t + first)[row])
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(text), b.column(1).take(text), *[pa.array(v[row]) for v in (g, x + before, a + before, z + before)], pa.array(role)],
                        names=[*ANCHOR, "role"])

    return texts.mapInArrow(run, "k1 long, k2 long, g long, x long, a long, b long, role int")


def repeated(rows: DataFrame) -> DataFrame:
    """Anchors whose gram starts at another anchor too. One shuffle; a group only streams by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, matched = None, False
        for b in batches:
            if not b.num_rows:
                continue
            v = np.stack([b.column(c).to_numpy() for c in [*ANCHOR, "role"]])
            sure = v[6] == SURE
            if sure.any():
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in v[:6, sure]], names=ANCHOR)
                v = v[:, ~sure]
            if held is not None:
                v = np.concatenate([held, v], axis=1)
            if not v.shape[1]:
                continue
            own = v[[0, 1, 2, 4]]
            fresh = np.concatenate([[True], (own[:, 1:] != own[:, :-1]).any(axis=0)])
            v = v[:, fresh]
            g = v[2]
            same = np.concatenate([[matched], g[1:] == g[:-1]])
            keep = (same[:-1] | same[1:]) & (v[6, :-1] == ASKED)
            held, matched = v[:, -1:], bool(same[-1])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in v[:6, :-1][:, keep]], names=ANCHOR)
        if held is not None and matched and held[6, 0] == ASKED:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[:6]], names=ANCHOR)

    place = F.when(F.col("role") == SURE, F.xxhash64("k1", "k2", "a")).otherwise(F.col("g"))
    dealt = rows.withColumn("place", place).repartition("place").sortWithinPartitions("g", "k1", "k2", "a", "role")
    return dealt.select(*ANCHOR, "role").mapInArrow(run, "k1 long, k2 long, g long, x long, a long, b long")


def spans(found: DataFrame, kind: Kind) -> DataFrame:
    """One row per repeated anchor: its group, its windows and their tokens (words joined by a space).

    Equal spans of one text (a repeated word fills it with them) are combined
    before the shuffle: one goes on, and the windows of all are reported as rows
    of level -1, with the range [a, a + n).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k1, k2, text, marks in rows_of(batches):
            units = text.split() if kind.words else text
            out: list[list] = [[] for _ in range(8)]
            first: dict[tuple[int, int, int], tuple[int, int]] = {}
            again: list[tuple[int, int]] = []
            for m in marks:
                a, z = m["a"], m["b"]
                body = units[a : z + kind.window]
                key = (m["g"], m["x"] - a, z - a)
                known = first.setdefault(key, (a, z))
                if known[0] != a and units[known[0] : known[1] + kind.window] == body:
                    again += [(known[0], known[1] + kind.window), (a, z + kind.window)]
                    continue
                row = (m["g"], k1, k2, a, m["x"] - a, z - a + 1, 0, b" ".join(body) if kind.words else body)
                for c, v in zip(out, row):
                    c.append(v)
                if len(out[0]) == FLUSH:
                    yield _span_batch(out)
                    out = [[] for _ in range(8)]
            for s, e in union_spans(sorted(set(again))):
                for c, v in zip(out, (k1, k1, k2, s, 0, e - s, -1, b"")):
                    c.append(v)
            if out[0]:
                yield _span_batch(out)

    return found.select("k1", "k2", "text", "marks").mapInArrow(run, SPANS)


def rows_of(batches: Iterator[pa.RecordBatch], step: int = 64) -> Iterator[tuple]:
    """Rows as Python values, a few at a time: a batch's texts and marks are never all unpacked."""
    for b in batches:
        for k in range(0, b.num_rows, step):
            yield from zip(*[c.to_pylist() for c in b.slice(k, step).columns])


FLUSH = 4096
DEFERRED = 2_000  # spans of oversized groups that a task holds before it sends them on
SPAN_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
SPAN_NAMES = ["g", "k1", "k2", "a", "left", "n", "level", "body"]


def _span_batch(cols: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, SPAN_TYPES)], names=SPAN_NAMES)


@dataclass
class Shard:
    """Spans of whole groups: equal ones collapsed into one."""

    group: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    n: list[int] = field(default_factory=list)
    bodies: list[bytes] = field(default_factory=list)
    rows: list[tuple] = field(default_factory=list)  # (k1, k2, a)
    size: int = 0


# A sorter gets a shard and returns, for each of its spans, which of its n windows repeat.
Sorter = Callable[[Shard, Kind], list[np.ndarray]]


def runs(hit: np.ndarray) -> np.ndarray:
    """(first, last + 1) of each run of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return edge.reshape(-1, 2)


def sort_groups(rows: DataFrame, kind: Kind, sorter: Sorter) -> DataFrame:
    """(k1, k2, s, e) token ranges covered by repeated windows; level > 0 rows are spans of oversized groups.

    Rows stream in sorted order (Spark's external sort keeps what does not fit
    on disk), so a task holds one shard at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, group, over = Shard(), None, False
        pending: Shard = Shard()  # the group that is being read
        last, last_row, last_sent = None, None, False  # the span read last, where it is, whether it was reported
        found: list[tuple] = []
        deferred: list[list] = [[] for _ in range(8)]

        def flush_found():
            nonlocal found
            if found:
                k1, k2, s, e = zip(*found)
                found = []
                nothing = pa.nulls(len(k1), pa.binary())
                zero64, zero32 = pa.array(np.zeros(len(k1), np.int64)), pa.array(np.zeros(len(k1), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [zero64, pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(s, pa.int64()), zero32, zero32, pa.array([-1] * len(k1), pa.int32()), nothing, pa.array(e, pa.int64())],
                    names=[*SPAN_NAMES, "e"])

        def flush_deferred():
            nonlocal deferred
            if deferred[0]:
                batch = _span_batch(deferred)
                deferred = [[] for _ in range(8)]
                yield batch.append_column("e", pa.nulls(batch.num_rows, pa.int64()))

        def defer(g, k1, k2, a, left, n, level, body):
            for c, v in zip(deferred, (g, k1, k2, a, left, n, level + 1, body)):
                c.append(v)

        def close_group():
            nonlocal pending, last
            if len(pending.bodies) > 1:
                number = shard.group[-1] + 1 if shard.group else 0
                shard.group += [number] * len(pending.bodies)
                shard.left += pending.left
                shard.n += pending.n
                shard.bodies += pending.bodies
                shard.rows += pending.rows
                shard.size += pending.size
            pending, last = Shard(), None

        def close_shard():
            nonlocal shard
            if shard.bodies:
                for (k1, k2, a), hit in zip(shard.rows, sorter(shard, kind)):
                    found.extend((k1, k2, a + int(s), a + int(e) - 1 + kind.window) for s, e in runs(hit))
            shard = Shard()

        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            for g, k1, k2, a, left, n, level, body in zip(*cols[:8]):
                if level < 0:  # reported by the span stage
                    found.append((k1, k2, a, a + n))
                    continue
                if g != group:
                    close_group()
                    group, over = g, False
                    if shard.size > kind.shard_bytes:
                        close_shard()
                if last == (left, n, body):  # the same span again: all its windows repeat
                    if (k1, k2, a) == last_row:
                        continue  # the same place, read twice
                    if not last_sent:
                        found.append((*last_row, last_row[2] + n - 1 + kind.window))
                        last_sent = True
                    found.append((k1, k2, a, a + n - 1 + kind.window))
                    last_row = (k1, k2, a)
                    continue
                last, last_row, last_sent = (left, n, body), (k1, k2, a), False
                if over:
                    defer(g, k1, k2, a, left, n, level, body)
                    if len(deferred[0]) >= DEFERRED:
                        yield from flush_deferred()
                    continue
                pending.left.append(left)
                pending.n.append(n)
                pending.bodies.append(body)
                pending.rows.append((k1, k2, a))
                pending.size += len(body)
                if pending.size > kind.group_bytes and kind.width(level) > 1:
                    over = True
                    for row, l, m, body_ in zip(pending.rows, pending.left, pending.n, pending.bodies):
                        defer(g, *row, l, m, level, body_)
                        if len(deferred[0]) >= DEFERRED:
                            yield from flush_deferred()
                    pending = Shard()
            if len(found) > 20_000:
                yield from flush_found()
        close_group()
        close_shard()
        yield from flush_found()
        yield from flush_deferred()

    placed = rows.withColumn("h", F.xxhash64("body")).repartition("g").sortWithinPartitions("g", "left", "n", "h", "k1", "k2", "a")
    return placed.select(*SPAN_NAMES).mapInArrow(run, SPANS + ", e long")


def narrow(rows: DataFrame, kind: Kind) -> DataFrame:
    """Spans of oversized groups, cut by narrower offset ranges and keyed by the longer prefix these share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            out: list[list] = [[] for _ in range(8)]
            for g, k1, k2, a, left, n, level, body in zip(*[c.to_pylist() for c in b.columns]):
                units = body.split() if kind.words else body
                wide = kind.width(level)
                low, high = left - n + 1, left  # offsets of the span's windows
                for q in range(low // wide, high // wide + 1):
                    lo, hi = max(low, q * wide), min(high, q * wide + wide - 1)
                    j = left - hi  # the first window of the part
                    part = units[j : left - lo + kind.window]
                    end = min(q * wide + wide - 1, kind.offsets - 1)
                    shared = units[left - q * wide : left - end + kind.window]
                    sep = b" " if kind.words else b""
                    key = xxhash.xxh64_intdigest((sep.join(shared) if kind.words else shared) + b"\n%d %d %d" % (g, level, q)) - (1 << 63)
                    row = (key, k1, k2, a + j, left - j, hi - lo + 1, level, sep.join(part) if kind.words else part)
                    for c, v in zip(out, row):
                        c.append(v)
            yield _span_batch(out)

    return rows.mapInArrow(run, SPANS)


def changed_texts(docs: DataFrame, kind: Kind, sorter: Sorter, scratch: Scratch) -> DataFrame:
    """(k1, k2, spans, text) of each distinct text that may lose something.

    ``spans``: sorted (s, e) token ranges to remove. A text with exact copies has
    null ``spans`` and ``text``: all of it goes if it is as long as a window.
    """
    keyed = docs.select(*text_keys(F.col("text")), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    found = repeated(sample(keyed, kind))
    marks = found.groupBy("k1", "k2").agg(F.collect_list(F.struct("g", "x", "a", "b")).alias("marks"))
    candidates = scratch.save(first_per_task(first_per_task(keyed).join(marks, ["k1", "k2"])))
    rows, ranges = spans(candidates, kind), None
    while True:
        level = scratch.save(sort_groups(rows, kind, sorter))
        own = level.where("level = -1").select("k1", "k2", F.col("a").alias("s"), "e")
        ranges = own if ranges is None else ranges.unionByName(own)
        again = level.where("level >= 0").select(*SPAN_NAMES)
        if again.isEmpty():
            break
        rows = narrow(again, kind)
    merged = ranges.groupBy("k1", "k2").agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("spans"))
    copies = scratch.save(keyed.groupBy("k1", "k2").agg(F.count("*").alias("copies")).where("copies > 1").select("k1", "k2"))
    own_text = candidates.select("k1", "k2", "text").dropDuplicates(["k1", "k2"])
    parts = merged.join(copies, ["k1", "k2"], "left_anti").join(own_text, ["k1", "k2"])
    whole = copies.select("k1", "k2", F.lit(None).cast("array<struct<s:bigint,e:bigint>>").alias("spans"), F.lit(None).cast("binary").alias("text"))
    return parts.select("k1", "k2", "spans", "text").unionByName(whole)


def union_spans(pairs: list[tuple[int, int]]) -> list[list[int]]:
    """Overlapping or touching (s, e) ranges as one; ``pairs`` are sorted."""
    out: list[list[int]] = []
    for s, e in pairs:
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


CHANGED = "k1 long, k2 long, n_removed long, spans array<struct<s:long,e:long>>, kept binary"
SPAN_LIST = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))


def without(tokens, ranges: list[list[int]]) -> list:
    """What is left of ``tokens`` between the removed ranges."""
    parts, at = [], 0
    for s, e in ranges:
        parts.append(tokens[at:s])
        at = e
    return [*parts, tokens[at:]]


def _joined(rows: DataFrame, changed: DataFrame, n: Column, window: int) -> tuple[DataFrame, Column, Column]:
    """``rows`` beside their text's change: (frame, whether a part goes, whether all goes)."""
    out = rows.join(changed.withColumn("hit", F.lit(True)), ["k1", "k2"], "left")
    part = F.col("hit").isNotNull() & F.col("n_removed").isNotNull()
    return out, part, F.col("hit").isNotNull() & F.col("n_removed").isNull() & (n >= window)


def applied(docs: DataFrame, changed: DataFrame, n: Column, whole: Column, window: int) -> DataFrame:
    """All rows and columns of ``docs`` with n_removed, spans and kept."""
    added = ("k1", "k2", "hit", "n_removed", "spans", "kept")
    own = [c for c in docs.columns if c not in added]
    out, part, everything = _joined(docs.select(*own, *text_keys(F.col("text"))), changed, n, window)
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("s"), n.cast("long").alias("e")))
    return out.select(
        *own,
        F.when(everything, n.cast("long")).when(part, F.col("n_removed")).otherwise(F.lit(0).cast("long")).alias("n_removed"),
        F.when(everything, all_of_it).when(part, F.col("spans")).otherwise(F.array().cast("array<struct<s:bigint,e:bigint>>")).alias("spans"),
        F.when(everything, F.lit(b"")).when(part, F.col("kept")).otherwise(whole).alias("kept"))


def digested(rows: DataFrame, changed: DataFrame, n: str, window: int) -> DataFrame:
    """``rows`` (k1, k2, ``n`` tokens, sha of the whole) with n_removed, n_spans and kept_sha256."""
    less = changed.select("k1", "k2", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha"))
    out, part, everything = _joined(rows, less, F.col(n), window)
    nothing, zero = F.sha2(F.lit(b""), 256), F.lit(0).cast("long")
    return out.withColumns({
        "kept_sha256": F.when(everything, nothing).when(part, F.col("kept_sha")).otherwise(F.col("sha")),
        "n_spans": F.when(everything, F.lit(1).cast("long")).when(part, F.col("n_spans")).otherwise(zero),
        "n_removed": F.when(everything, F.col(n)).when(part, F.col("n_removed")).otherwise(zero)})

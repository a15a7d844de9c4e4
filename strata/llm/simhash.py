"""SimHash near-dedup (operator 2) with pigeonring filtering.

Fingerprints: a bit is set where over half of the text's shingle hashes have it.

Two fingerprints that differ in at most ``tau`` bits, cut into a ring of ``m``
segments, have a chain: some start from which every run of l consecutive
segments differs in at most ``l * tau / m`` bits. So of the first segments of a
chain only so many may differ at all, and the others are equal: they are the
bucket keys, one for each start and each admissible set of differing segments.
Inside a bucket a pair must pass the chain's cumulative budgets from that start
before its full Hamming distance is taken. A linked pair passes at one start at
least, so no link is lost.

Copies are collapsed first: only distinct fingerprints are bucketed. A bucket is
searched breadth-first and gives a spanning forest, not its pairs. One that
exceeds ``bucket_limit`` is not gathered: its rows get another ring over the bits
that its key leaves open, and go round again; the open bits shrink each time, so
this ends with buckets of at most ``2 ** tau`` rows. Components are joined in Spark.

Defined cases: a text without words (null included) has fingerprint zero, linked
like any other; fewer words than a shingle make one shingle; a null doc_id is
never a component's id unless the component has no other (then null); repeated
rows get a row each; extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.llm.common import Scratch
from strata.llm.components import components

SHINGLE = 4
SEED = 42
TAU = 4
SEGMENTS = 7
BUCKET_LIMIT = 20_000


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of every shingle of the ASCII-lower-cased words, repeats included."""
    words = text.lower().split()
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-shingle].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(flat[s:e], SEED) for s, e in zip(starts, (ends[shingle - 1 :] - 1).tolist())), np.uint64, len(words) - shingle + 1)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    h = shingle_hashes(text, shingle)
    if not len(h):
        return 0
    total = np.zeros(64, np.int64)
    for k in range(0, len(h), 65_536):
        total += np.unpackbits(h[k : k + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long. Narrow: no shuffle."""
    schema = StructType([docs.schema["doc_id"], StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


class Ring:
    """Bucket keys and chain budgets of a ring over the given bit positions."""

    def __init__(self, bits: tuple[int, ...], tau: int, segments: int):
        m = min(segments, len(bits))
        cut = [len(bits) * k // m for k in range(m + 1)]
        seg = [sum(1 << p for p in bits[a:b]) for a, b in zip(cut, cut[1:])]
        budget = [k * tau // m for k in range(m + 1)]
        length = max(range(1, m + 1), key=lambda k: (k - budget[k], -k))
        self.bits, self.budget = bits, budget
        self.masks: list[int] = []  # of the equal bits, one for each bucket key
        self.chains: list[list[int]] = []  # cumulative segment masks from the key's start
        done = set()
        for start in range(m):
            chain, total = [], 0
            for k in range(m):
                total |= seg[(start + k) % m]
                chain.append(total)
            for differ in combinations(range(1, length), budget[length]):
                if any(sum(d < k for d in differ) > budget[k] for k in range(1, length + 1)):
                    continue
                mask = sum(seg[(start + k) % m] for k in range(length) if k not in differ)
                if (mask, start) not in done:
                    done.add((mask, start))
                    self.masks.append(mask)
                    self.chains.append(chain)


@lru_cache(maxsize=4096)
def ring_of(path: tuple[int, ...], tau: int, segments: int) -> Ring:
    """The ring whose keys extend the buckets of ``path`` (the key numbers taken so far)."""
    if not path:
        return Ring(tuple(range(64)), tau, segments)
    above = ring_of(path[:-1], tau, segments)
    mask = above.masks[path[-1]]
    return Ring(tuple(p for p in above.bits if not mask >> p & 1), tau, segments)


BASE = 128  # key numbers of a ring stay below this: a path is a number to this base


def path_of(number: int) -> tuple[int, ...]:
    out = []
    while number:
        out.append(number % BASE - 1)
        number //= BASE
    return tuple(reversed(out))


def expand(rows: DataFrame, tau: int, segments: int) -> DataFrame:
    """(path, fp) rows to one row for each key of the next ring: (path, key, fp)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths, fps = b.column(0).to_numpy(), b.column(1).to_numpy()
            for number in np.unique(paths).tolist():
                own = fps[paths == number]
                for k, mask in enumerate(ring_of(path_of(number), tau, segments).masks):
                    key = own & np.uint64(mask).view(np.int64)
                    path = np.full(len(own), number * BASE + k + 1, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(key), pa.array(own)], names=["path", "key", "fp"])

    return rows.select("path", "fp").mapInArrow(run, "path long, key long, fp long")


def pair_mask(x: np.ndarray, ring: Ring, key_no: int, tau: int) -> np.ndarray:
    """Which XORs pass the chain's cumulative budgets from the key's start, and then the full distance."""
    alive = np.arange(len(x))
    for mask, most in zip(ring.chains[key_no], ring.budget[1:]):
        alive = alive[np.bitwise_count(x[alive] & np.uint64(mask)) <= most]
        if not len(alive):
            break
    out = np.zeros(len(x), bool)
    out[alive] = np.bitwise_count(x[alive]) <= tau
    return out


def forest(fps: np.ndarray, ring: Ring, key_no: int, tau: int) -> list[tuple[int, int]]:
    """Spanning forest of a bucket's links, breadth-first; a fingerprint leaves the search when reached."""
    rest, links = fps, []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            u = queue.pop()
            near = pair_mask(rest ^ u, ring, key_no, tau)
            if near.any():
                found = rest[near]
                links += [(int(u), int(v)) for v in found]
                queue += list(found)
                rest = rest[~near]
    return links


class Forest:
    """Union-find over one task's links: a link inside a known component is not sent again."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (y := up.get(root, root)) != root:
            root = y
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[a] = b
        return True


def search(keyed: DataFrame, tau: int, segments: int, limit: int) -> DataFrame:
    """Buckets of (path, key, fp) to links (path -1: a, b) and rows of oversized buckets (path, a = fp)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, over = Forest(), None
        held = [np.zeros(0, np.int64)] * 3

        def out(path, a, b) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (path, a, b)], names=["path", "a", "b"])

        def link(paths, fps, starts, sizes) -> list[tuple[int, int]]:
            found = []
            two = starts[sizes == 2]
            for number in np.unique(paths[two]).tolist():
                at = two[paths[two] == number]
                path = path_of(number)
                ok = pair_mask((fps[at] ^ fps[at + 1]).view(np.uint64), ring_of(path[:-1], tau, segments), path[-1], tau)
                found += zip(fps[at[ok]].tolist(), fps[at[ok] + 1].tolist())
            for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                path = path_of(int(paths[s]))
                links = forest(fps[s : s + n].view(np.uint64), ring_of(path[:-1], tau, segments), path[-1], tau)
                found += [(int(np.uint64(a).view(np.int64)), int(np.uint64(b).view(np.int64))) for a, b in links]
            return [x for x in found if seen.join(*x)]

        def finish(path, key, fp, last: bool):
            """Handles the whole buckets of sorted rows; keeps the last, which may go on."""
            nonlocal held, over
            if not len(path):
                held = [path, key, fp]
                return
            edge = np.flatnonzero((path[1:] != path[:-1]) | (key[1:] != key[:-1])) + 1
            starts = np.concatenate([[0], edge])
            sizes = np.diff(np.concatenate([starts, [len(path)]]))
            if over is not None:  # the first bucket goes on from an oversized one
                n = int(sizes[0]) if (path[0], key[0]) == over else 0
                if n:
                    yield out(path[:n], fp[:n], fp[:n])
                if n == len(path) and not last:
                    held = [x[:0] for x in (path, key, fp)]
                    return
                over = None
                if n:
                    yield from finish(path[n:], key[n:], fp[n:], last)
                    return
            big = sizes > limit
            if not last:
                tail = int(starts[-1])
                if big[-1]:
                    over = (path[tail], key[tail])
                    held = [x[:0] for x in (path, key, fp)]
                else:
                    held = [path[tail:], key[tail:], fp[tail:]]
                    starts, sizes, big = starts[:-1], sizes[:-1], big[:-1]
            for s, n in zip(starts[big].tolist(), sizes[big].tolist()):
                yield out(path[s : s + n], fp[s : s + n], fp[s : s + n])
            links = link(path, fp, starts[~big], sizes[~big])
            if links:
                a, b = zip(*links)
                yield out([-1] * len(a), a, b)

        for batch in batches:
            if batch.num_rows:
                yield from finish(*[np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns)], False)
        yield from finish(*held, True)

    placed = keyed.repartition("path", "key").sortWithinPartitions("path", "key")
    return placed.mapInArrow(run, "path long, a long, b long")


def links(nodes: DataFrame, scratch: Scratch, tau: int = TAU, segments: int = SEGMENTS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that span the components at distance ``tau``."""
    if bucket_limit < 2**tau:
        raise ValueError("bucket_limit must be at least 2 ** tau")
    rows, found = nodes.select(F.lit(0).cast("long").alias("path"), "fp"), None
    while True:
        level = scratch.save(search(expand(rows, tau, segments), tau, segments, bucket_limit))
        own = level.where("path = -1").select("a", "b")
        found = own if found is None else found.unionByName(own)
        rows = level.where("path >= 0").select("path", F.col("a").alias("fp"))
        if rows.isEmpty():
            return found


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, tau: int = TAU, segments: int = SEGMENTS, bucket_limit: int = BUCKET_LIMIT
) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text)."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.save(fingerprints(docs, shingle))
    nodes = scratch.save(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    edges = scratch.save(links(nodes, scratch, tau, segments, bucket_limit))
    roots = components(edges, scratch)
    mapped = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    mapped = scratch.save(mapped)
    smallest = mapped.groupBy("root").agg(F.min("rep").alias("component_id"))
    ids = mapped.join(smallest, "root").select("fp", "component_id")
    return rows.join(ids, "fp").select("doc_id", "fp", "component_id")

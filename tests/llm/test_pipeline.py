"""The pipeline against a brute-force version of its stages, on a table with planted cases."""

from __future__ import annotations

import random
import re
from collections import Counter

import brute
import corpus_pipeline
import pytest

from strata.llm import quality
from strata.llm.packing import encoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def planted():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopé") for _ in range(rng.randint(2, 8))) for _ in range(400)]

    def prose(n):
        words = [rng.choice(vocabulary) for _ in range(n)]
        return "\n".join(" ".join(words[i : i + 14]) + "." for i in range(0, n, 14))

    items = [(k, prose(30)) for k in range(4)] + [(4, None), (5, "")]
    passage = prose(110)
    texts = [prose(rng.randint(60, 400)) for _ in range(30)]
    texts += [texts[2], texts[3].replace(" ", "  ", 3), texts[4] + " tail"]  # copy, same words, near copy
    texts += [prose(80) + "\n" + items[k][1] + "\n" + prose(60) for k in range(3)]  # leaks
    texts += [prose(90) + "\n" + passage + "\n" + prose(70) for _ in range(3)]  # repeated passage
    for n in (51, 55, 70):  # passages of over 50 words, below and above 400 bytes
        short = prose(n)
        texts += [prose(100) + "\n" + short + "\n" + prose(60 + k) for k in range(2)]
    texts += ["### $$$ | *** " * 40, "again and again " * 60, "too short", "", None, "Home\nLogin\n" + prose(120), prose(2500)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[7], (None, texts[9] + " " + prose(90), None, None, None), (None, prose(100), None, None, None)], items


def brute_force(rows, items):
    rules = quality.LineRules()
    docs = []
    for d, t, *_ in rows:
        counts, clean = quality.judge((t or "").encode(), rules)
        n = counts["n_words"]
        if n >= 50 and 2 * counts["n_repeat_words"] <= n and counts["n_lost_words"] <= 0.3 * n:
            docs.append((d, clean.decode()))
    fps = [brute.fingerprint(t) for _, t in docs]
    groups = brute.linked(sorted(set(fps)), lambda a, b: (a ^ b).bit_count() <= 4)
    kept = {}
    for (d, t), f in zip(docs, fps):
        key, component = (d is None, d or 0), min(groups[f])
        kept.setdefault(component, []).append((key, t, d))
    docs = []
    for members in kept.values():
        least = min(k for k, _, _ in members)
        docs.append(next((d, t) for k, t, d in members if k == least))
    bodies = [t.encode() for _, t in docs]
    cut = []
    for (d, t), mask in zip(docs, brute.repeated_windows(bodies, corpus_pipeline.PASSAGES.window)):
        at, left = 0, []
        for c in t:
            size = len(c.encode())
            if not any(mask[at : at + size]):
                left.append(c)
            at += size
        if "".join(left).strip(" \t\n\r\x0b\x0c"):
            cut.append((d, "".join(left)))
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    wanted = [grams(words(t)) for _, t in items if t]
    clean = [(d, t) for d, t in cut if not any(len(g & grams(words(t))) >= 0.8 * len(g) for g in wanted)]
    out = Counter()
    for d, t in clean:
        n = len(encoder().encode_ordinary(t)) + 1
        first = n % 1024 or min(n, 1024)
        edges = [0, *range(first, n + 1, 1024)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            out[d, k, a, b - a] += 1
    return out


@pytest.fixture(scope="module")
def folder(spark):
    from strata.session import shared_scratch
    import uuid

    rows, items = planted()
    path = shared_scratch(spark, f"pipeline-test-{uuid.uuid4().hex[:10]}")
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_run_equals_brute_force(spark, folder):
    out = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in out) == brute_force(*planted())
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_passages_of_over_fifty_words_go(spark, folder):
    rows = spark.createDataFrame([r for r in planted()[0] if r[1]], SCHEMA)
    texts = [t for _, t, *_ in planted()[0] if t]
    again = [w for k, w in enumerate(texts) for v in texts[:k] if v != w and shared_words(v, w) > 50]
    assert again and min(len(t.encode()) for t in again) > 400
    left = [r.text for r in corpus_pipeline.repeated_passages(spark, rows, folder).collect()]
    assert not any(v != w and shared_words(v, w) > 50 for k, w in enumerate(left) for v in left[:k])


def shared_words(v, w):
    """Longest run of words that two texts share, by runs of 51."""
    runs = lambda t: {tuple(t[i : i + 51]) for i in range(len(t) - 50)}
    return 51 if runs(v.split()) & runs(w.split()) else 0


def test_stages_return_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, folder)
        assert out.columns == docs.columns and out.count() == 0, name

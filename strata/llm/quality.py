"""Quality rules (operator 6), line-first cleaning.

Every line of a text is judged by punctuation, navigation and boilerplate
rules; failing lines are removed; a document that loses too large a share of
its words is rejected. Document-level base counts come with the verdict.

Most rules know no language: symbols, separators, lines of punctuation alone, repeats of
an earlier line, lines that are mostly links, and menus, which are runs of short
lines without an end of sentence. Two lists of English phrases come on top.

Defined cases: null or empty text has no words, fails the base check and is not
kept; repeated rows get one row each; other columns of the input pass through
untouched, and those named like an output column are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = b"#*$%&|<>"
SEPARATORS = (b" | ", b" > ", " » ".encode(), " › ".encode())
NAVIGATION = frozenset((b"home", b"next", b"previous", b"menu", b"login", b"log in", b"sign in", b"sign up", b"register",
                        b"subscribe", b"share", b"back to top", b"skip to content", b"read more", b"search",
                        b"contact us", b"about us", b"sitemap"))
BOILERPLATE = (b"all rights reserved", b"terms of use", b"terms of service", b"privacy policy", b"cookie policy",
               b"accept cookies", b"we use cookies", b"javascript is disabled", b"enable javascript", b"lorem ipsum",
               b"powered by", b"(c) copyright")
# Marks that end a sentence or a part of one, marks that may close it, beginnings of links.
STOPS = ".!?:;,…。"
CLOSERS = "\"')’”»"
LINKS = (b"http://", b"https://", b"www.")
_either = lambda marks: "|".join(map(re.escape, marks)).encode()
ENDS = re.compile(b"(?:" + _either(STOPS) + b")(?:" + _either(CLOSERS) + b")*\\Z")


@dataclass(frozen=True)
class LineRules:
    """Parameters of the line rules; the defaults are the production settings."""

    symbol_share: float = 0.10  # symbols per character from which a line fails
    max_separators: int = 3  # so many ' | ' or ' > ' make a navigation bar
    max_link_share: float = 0.50  # share of a line's words that may be links
    menu_words: int = 4  # a line of at most so many words that ends no sentence may be a menu's
    menu_lines: int = 4  # so many of them, one after the other, are a menu
    max_lost_share: float = 0.30  # share of words in failed lines above which a document goes
    min_words: int = 50
    repeat_share: int = 50  # per cent of words in repeated 3-word windows above which a document goes


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words")


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    m = len(ids)
    if m < 2_000_000:
        win = (a[:-2] * m + a[1:-1]) * m + a[2:]
    else:  # the product would not fit 64 bits: number the pairs first
        pairs = np.unique(a[:-1] * m + a[1:], return_inverse=True)[1]
        win = pairs[:-1].astype(np.int64) * m + a[2:]
    _, inverse, counts = np.unique(win, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    if not twice.any():
        return 0
    hit = np.zeros(n, bool)
    for d in range(3):
        hit[d : n - 2 + d] |= twice
    return int(hit.sum())


def line_fails(line: bytes, rules: LineRules) -> bool:
    """Punctuation, navigation and boilerplate rules on one line that has a word."""
    body = line.strip()
    symbols = len(body) - len(body.translate(None, SYMBOLS))
    if symbols > rules.symbol_share * len(body):
        return True
    if sum(body.count(s) for s in SEPARATORS) >= rules.max_separators:
        return True
    if not any(c > 127 or chr(c).isalnum() for c in body):  # punctuation only
        return True
    words = body.split()
    if sum(w.startswith(LINKS) for w in words) > rules.max_link_share * len(words):
        return True
    low = body.lower()
    return low.strip(b" .!:>|-") in NAVIGATION or any(p in low for p in BOILERPLATE)


def menu_lines(lines: list[bytes], sizes: list[int], rules: LineRules) -> set[int]:
    """Numbers of the lines in menus: ``rules.menu_lines`` or more short lines that end no sentence, blank lines aside."""
    found: set[int] = set()
    run: list[int] = []
    for i, n in enumerate([*sizes, -1]):
        if 0 < n <= rules.menu_words and not ENDS.search(lines[i].rstrip()):
            run.append(i)
        elif n:  # another line with words, or the end
            if len(run) >= rules.menu_lines:
                found.update(run)
            run = []
    return found


def judge(text: bytes, rules: LineRules) -> tuple[dict[str, int], bytes]:
    """Counts over the whole text and the text left when failing lines are removed.

    A line fails by ``line_fails``, as a part of a menu or as a repeat of an earlier line of the text.
    """
    words = text.split()
    lines = text.split(b"\n")
    sizes = [len(line.split()) for line in lines]
    menu = menu_lines(lines, sizes, rules)
    kept_lines, seen, dup, lost = [], set(), 0, 0
    for i, (line, n) in enumerate(zip(lines, sizes)):
        if not n:
            kept_lines.append(line)
            continue
        repeat = line in seen
        dup += repeat
        seen.add(line)
        if repeat or i in menu or line_fails(line, rules):
            lost += n
        else:
            kept_lines.append(line)
    counts = {
        "n_words": len(words),
        "word_chars": len(b"".join(words).decode("utf-8", "replace")),
        "n_symbols": len(text) - len(text.translate(None, SYMBOLS)),
        "n_dup_lines": dup,
        "n_repeat_words": repeat_words(words),
        "n_lost_words": lost,
    }
    return counts, b"\n".join(kept_lines) if lost else text


def line_first(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """All rows of ``docs`` with the counts, ``clean_text``, ``base_failed`` and ``kept``.

    One narrow pass without a shuffle: a row's verdict needs that row only.
    """
    added = (*COUNTS, "clean_text", "base_failed", "kept")
    rest = [c for c in docs.columns if c not in added]
    src = docs.select(*rest, F.col(text).cast("binary").alias("__text"))
    fields = [docs.schema[c] for c in rest] + [StructField(c, LongType()) for c in COUNTS]
    fields += [StructField("clean_text", StringType()), StructField("base_failed", BooleanType()), StructField("kept", BooleanType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {c: [] for c in added}
            for v in b.column(b.num_columns - 1):
                counts, clean = judge(v.as_py() or b"", rules)
                for c in COUNTS:
                    out[c].append(counts[c])
                n = counts["n_words"]
                base = n < rules.min_words or 100 * counts["n_repeat_words"] > rules.repeat_share * n
                out["clean_text"].append(clean.decode("utf-8", "replace"))
                out["base_failed"].append(base)
                out["kept"].append(not base and counts["n_lost_words"] <= rules.max_lost_share * n)
            arrays = [pa.array(out[c], pa.int64()) for c in COUNTS]
            arrays += [pa.array(out["clean_text"], pa.string()), pa.array(out["base_failed"], pa.bool_()), pa.array(out["kept"], pa.bool_())]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(b.num_columns - 1)] + arrays, names=rest + list(added))

    return src.mapInArrow(run, StructType(fields))


def _sql_list(values) -> str:
    return ", ".join("'" + v.decode() + "'" for v in sorted(values))


def oracle_sql(rules: LineRules = LineRules()) -> str:
    """The same verdicts in DuckDB SQL over the view ``documents``."""
    sep = " + ".join(f"(strlen(body) - strlen(replace(body, '{s.decode()}', ''))) // {len(s)}" for s in SEPARATORS)
    links = "|".join(re.escape(x.decode()) for x in LINKS)
    symbols = "len(regexp_extract_all({}, '[#*$%&|<>]'))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '{WORD}') AS ws FROM d),
x AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
t AS (SELECT rid, i, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM x WINDOW o AS (PARTITION BY rid ORDER BY i)),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, word, w2, w3) AS n FROM t WHERE w3 IS NOT NULL),
r AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM g CROSS JOIN (VALUES (0), (1), (2)) s(k) WHERE n > 1 GROUP BY rid),
sp AS (SELECT rid, string_split(text, chr(10)) AS ls FROM d),
l0 AS (SELECT rid, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM sp),
l1 AS (SELECT rid, i, line, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS body,
              len(regexp_extract_all(line, '{WORD}')) AS n, row_number() OVER (PARTITION BY rid, line ORDER BY i) AS nth FROM l0),
s0 AS (SELECT *, n <= {rules.menu_words} AND NOT regexp_matches(body, '[{STOPS}][{CLOSERS.replace("'", "''")}]*$') AS short,
              row_number() OVER (PARTITION BY rid ORDER BY i) AS place FROM l1 WHERE n > 0),
s1 AS (SELECT *, place - row_number() OVER (PARTITION BY rid, short ORDER BY i) AS run FROM s0),
s2 AS (SELECT *, short AND count(*) OVER (PARTITION BY rid, short, run) >= {rules.menu_lines} AS menu FROM s1),
l2 AS (SELECT *, nth > 1 AS again, nth > 1 OR menu OR {symbols.format('body')} > {rules.symbol_share} * strlen(body)
              OR {sep} >= {rules.max_separators} OR NOT regexp_matches(body, '[0-9A-Za-z]|[^\\x00-\\x7F]')
              OR len(regexp_extract_all(body, '(^|[\\x20\\x09-\\x0D])({links})')) > {rules.max_link_share} * n
              OR trim(lower(body), ' .!:>|-') IN ({_sql_list(NAVIGATION)})
              OR {' OR '.join(f"contains(lower(body), '{p.decode()}')" for p in BOILERPLATE)} AS fails FROM s2),
l AS (SELECT rid, count(*) FILTER (WHERE again) AS n_dup_lines, coalesce(sum(n) FILTER (WHERE fails), 0) AS lost FROM l2 GROUP BY rid),
c AS (SELECT d.rid, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             {symbols.format('text')} AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
      FROM d JOIN w USING (rid) LEFT JOIN r USING (rid) LEFT JOIN l USING (rid)),
b AS (SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.repeat_share} * n_words AS base_failed FROM c)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND lost <= {rules.max_lost_share} * n_words AS kept
FROM b"""

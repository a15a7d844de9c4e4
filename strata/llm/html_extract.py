"""HTML extraction (operator 3): gradient-boosted trees over DOM nodes, decoded as a tree.

The model is trained on the table itself. A bounded sample of pages
(``sample_pages``, those with the smallest hash of their html) gives text
fragments: main text from <article>/<main>, and menus, adverts and footers from
the elements that say so. From these, training pages are laid out anew with every
wrapper either as the HTML5 element or as a container whose class or id tells its
role, with sidebars, notices, forms and reader comments added, long and short menus,
lists and tables in the article, articles of one long block and pages without any
wrapper, so that the trees learn densities, attribute tokens, depth and sibling
statistics together and not one template. Nodes of main text are labelled 1, the
others 0, and Spark ML's gradient-boosted trees are fitted on them. What the decoder
charges for mixed nodes is set on further such pages: the charge with the fewest
wrong characters.

Every page is then parsed, its nodes scored and decoded in one narrow pass: the
labelling of the whole tree with the best total, in which no kept node hangs below
a dropped one or the other way round.

Defined cases: null or empty html gives an empty text; a page cut off in the
middle is read as far as it goes; an empty table gives an empty result; repeated
rows get a row each; extra columns pass through unless named ``text`` or ``n_chars``.
"""

from __future__ import annotations

import html as markup
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.llm.dom import BAD, SWITCH, Page, decode, features, parse

SAMPLE_PAGES = 300
ROUNDS, DEPTH = 20, 5
SWITCHES = (0.0, 1.0, 2.0, 4.0, 6.0, 10.0, 15.0, 25.0, 40.0)
MAIN = {"article", "main"}
ASIDE = {"nav": "menu", "header": "edge", "footer": "edge", "aside": "side", "form": "form"}


@dataclass(frozen=True)
class Trees:
    """A fitted ensemble as arrays: one row per tree, nodes by position; leaves point to themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weight: np.ndarray
    switch: float = SWITCH

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(len(self.weight)):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                lower = x[rows, self.feature[t][at]] <= self.threshold[t][at]
                at = np.where(lower, self.left[t][at], self.right[t][at])
            total += self.weight[t] * self.value[t][at]
        return 2 * total


def to_arrays(model) -> Trees:
    """The trees of a fitted Spark model, read node by node."""
    size = 2 ** (DEPTH + 1)
    trees = model._java_obj.trees()
    shape = (len(trees), size)
    feature, left, right = (np.zeros(shape, np.int64) for _ in range(3))
    threshold, value = np.zeros(shape), np.zeros(shape)
    for t, tree in enumerate(trees):
        queue, used = [(tree.rootNode(), 0)], 1
        while queue:
            node, i = queue.pop()
            value[t, i] = node.prediction()
            left[t, i] = right[t, i] = i
            if node.getClass().getSimpleName() == "InternalNode":
                feature[t, i] = node.split().featureIndex()
                threshold[t, i] = node.split().threshold()
                left[t, i], right[t, i] = used, used + 1
                queue += [(node.leftChild(), used), (node.rightChild(), used + 1)]
                used += 2
    return Trees(feature, threshold, left, right, value, np.array(list(model.treeWeights)))


def fragments(pages: list[str]) -> tuple[list[list[str]], dict[str, list[str]]]:
    """Main texts as lists of blocks, and blocks of other roles, from elements that name their role."""
    main, other = [], {k: [] for k in BAD}
    for html in pages:
        page = parse(html)
        own: dict[int, list[str]] = {}
        for node, text, _ in page.blocks:
            i = node
            while i >= 0:
                if page.tag[i] in MAIN:
                    own.setdefault(i, []).append(text)
                    break
                kind = ASIDE.get(page.tag[i]) or next((k for k in BAD if k in page.kinds[i]), None)
                if kind:
                    other[kind].append(text)
                    break
                i = page.parent[i]
        main += own.values()
    return main, other


def layout(rng: random.Random, main: list[list[str]], other: dict[str, list[str]]) -> str:
    """One training page; main text sits in elements marked with the attribute ``data-main``."""
    esc = markup.escape
    everything = [b for blocks in main for b in blocks] or ["text"]

    def some(kind: str, least: int, most: int) -> list[str]:
        pool = other.get(kind) or [" ".join(b.split()[:6]) for b in rng.sample(everything, min(8, len(everything)))]
        return [rng.choice(pool) for _ in range(rng.randint(least, most))]

    def wrapped(kind: str, element: str, inner: str) -> str:
        name = rng.choice(sorted(BAD[kind]))
        how = rng.random()
        if how < 0.4:
            return f"<{element}>{inner}</{element}>"
        tag = rng.choice(["div", "section", "div", element])
        return f'<{tag} {rng.choice(["class", "id"])}="{rng.choice(["", "site-", "page_", "l-"])}{name}">{inner}</{tag}>'

    def links(texts: list[str]) -> str:
        return "<ul>" + "".join(f'<li><a href="/{k}">{esc(t[:60])}</a></li>' for k, t in enumerate(texts)) + "</ul>"

    def paragraphs(texts: list[str]) -> str:
        return "".join(f"<p>{esc(t)}</p>" for t in texts)

    body = rng.choice(main)[:60] if main else ["text"]
    shape = rng.random()
    if shape < 0.12:  # one long block
        body = [" ".join(t for _ in range(rng.randint(1, 5)) for t in rng.choice(main))] if main else body
    elif shape < 0.25:  # a short article
        body = body[: rng.randint(1, 3)]
    if rng.random() < 0.06:  # a page that is its text
        return rng.choice(["<html><body data-main>{}</body></html>", "<p data-main>{}</p>", "<body><div data-main>{}</div></body>"]).format(esc(" ".join(body)))
    blocks = []
    for k, t in enumerate(body):
        tag = "h1" if k == 0 and len(body) > 1 and rng.random() < 0.6 else rng.choice(["p"] * 12 + ["h2", "blockquote", "li", "div"])
        listed = rng.random()
        if k and listed < 0.06:
            items = [x for x in re.split(r"(?<=[.,;!?]) ", t) if x][:8]
            blocks.append(rng.choice(["<ul>{}</ul>", "<ol>{}</ol>"]).format("".join(f"<li data-main>{esc(x)}</li>" for x in items)))
            continue
        if k and listed < 0.1:
            cells = t.split()[:24]
            rows_ = [cells[i : i + 3] for i in range(0, len(cells), 3)]
            blocks.append("<table>" + "".join("<tr>" + "".join(f"<td data-main>{esc(x)}</td>" for x in r) + "</tr>" for r in rows_) + "</table>")
            continue
        text = esc(t) if rng.random() < 0.8 else f'<a href="/x">{esc(t[: len(t) // 3])}</a>{esc(t[len(t) // 3 :])}'
        blocks.append(f"<{tag} data-main>{text}</{tag}>")
    inside = "".join(blocks)
    if rng.random() < 0.05:  # no wrapper and nothing beside the article
        return f"<html><head><title>t</title></head><body>{inside}</body></html>"
    if rng.random() < 0.3:
        inside = f"<div>{inside}</div>"
    extra = []
    if rng.random() < 0.3:
        extra.append(wrapped("talk", "section", "".join(f"<div><b>{esc(t[:12])}</b><p>{esc(t[:300])}</p></div>" for t in rng.sample(everything, min(3, len(everything))))))
    if rng.random() < 0.25:
        extra.append(wrapped("advert", "div", esc(rng.choice(some("advert", 1, 1)))))
    if rng.random() < 0.2:
        extra.append(wrapped("talk", "div", links(["Share", "Tweet", "Mail"])))
    within = rng.random() < 0.5
    holder = rng.choice(['<article>{}</article>', '<main>{}</main>', '<div class="content">{}</div>', '<div id="article-body">{}</div>',
                         '<main><article class="post">{}</article></main>', '<div class="entry-content">{}</div>', "<div>{}</div>"])
    centre = holder.format(inside + "".join(extra) * within) + "".join(extra) * (not within)
    before = []
    if rng.random() < 0.9:
        before.append(wrapped("menu", "nav", links(some("menu", 3, rng.choice([9, 9, 16, 30])))))
    if rng.random() < 0.4:
        before.append(wrapped("edge", "header", esc(rng.choice(everything)[:40])))
    if rng.random() < 0.6:
        before.append(wrapped("advert", "aside", esc(rng.choice(some("advert", 1, 1) + [rng.choice(everything)[:200]]))))
    if rng.random() < 0.3:
        before.append(wrapped("notice", "dialog", paragraphs([rng.choice(everything)[:200]])))
    after = []
    if rng.random() < 0.4:
        after.append(wrapped("side", "aside", rng.choice([links, paragraphs])([t[:150] for t in rng.sample(everything, min(4, len(everything)))])))
    if rng.random() < 0.3:
        after.append(wrapped("form", "form", f"<label>{esc(rng.choice(everything)[:30])}</label><input><p>{esc(rng.choice(everything)[:80])}</p>"))
    if rng.random() < 0.9:
        after.append(wrapped("edge", "footer", esc("© " + rng.choice(some("edge", 1, 1))[:200])))
    rng.shuffle(before)
    inner = "".join(before) + centre + "".join(after)
    if rng.random() < 0.3:
        inner = f'<div class="wrapper">{inner}</div>'
    return f"<html><head><title>t</title></head><body>{inner}</body></html>"


def laid_out(pages: list[str], number: int, seed: int) -> Iterator[tuple[Page, np.ndarray]]:
    """Pages laid out anew, and which of their blocks are main text."""
    rng = random.Random(seed)
    main, other = fragments(pages)
    if not main:
        main = [[f"Paragraph {k} of a plain article, with a sentence or two." for k in range(6)]]
    for _ in range(number):
        html = layout(rng, main, other)
        # the mark is read from the source, then taken out, so that no feature can see it
        marked = parse(_mark(html))
        yield parse(html.replace(" data-main", "")), np.array([text.startswith("⁣") for _, text, _ in marked.blocks], bool)


def training_rows(pages: list[str], copies: int = 2, seed: int = 17) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the text-owning nodes of the laid out pages."""
    x, y = [], []
    for page, main in laid_out(pages, copies * max(50, len(pages)), seed):
        rows = features(page)
        for (node, _, _), own in zip(page.blocks, main):
            x.append(rows[node])
            y.append(own)
    return np.array(x), np.array(y, float)


def calibrated(trees: Trees, pages: list[str], seed: int = 71) -> Trees:
    """``trees`` with the switch cost that gets the fewest characters wrong on laid out pages of their own."""
    wrong = dict.fromkeys(SWITCHES, 0)
    for page, main in laid_out(pages, max(50, len(pages)), seed):
        odds = trees.log_odds(features(page))
        want = Counter(text for (_, text, _), own in zip(page.blocks, main) if own)
        for cost in SWITCHES:
            got = Counter(decode(page, odds, cost))
            wrong[cost] += sum(len(t) * n for t, n in ((want - got) + (got - want)).items())
    return replace(trees, switch=min(SWITCHES, key=lambda c: (wrong[c], c)))


def _mark(html: str) -> str:
    """Main blocks with an invisible sign before their text."""
    parts = html.split(" data-main>")
    return ">⁣".join(parts)


def train(pages: DataFrame, html: str = "html", sample_pages: int = SAMPLE_PAGES) -> Trees:
    # the smallest hashes first: the pages themselves only travel for the sample
    hashed = pages.select(F.xxhash64(html).alias("k"), F.col(html).alias("h")).where("h IS NOT NULL")
    least = hashed.select("k").distinct().orderBy("k").limit(sample_pages).agg(F.max("k")).first()[0]
    sample = hashed.where(F.col("k") <= F.lit(least)).groupBy("k").agg(F.min("h").alias("h")).orderBy("k")
    pages_of_sample = [r.h for r in sample.collect()]
    x, y = training_rows(pages_of_sample)
    rows = [(float(label), Vectors.dense(v)) for v, label in zip(x, y)]
    frame = pages.sparkSession.createDataFrame(rows, ["label", "features"]).coalesce(2).cache()
    try:
        model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, seed=17).fit(frame)
        return calibrated(to_arrays(model), pages_of_sample)
    finally:
        frame.unpersist()


def extract(pages: DataFrame, trees: Trees, html: str = "html") -> DataFrame:
    """All rows and columns of ``pages`` but the html, with ``text`` and ``n_chars``."""
    own = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    schema = StructType([pages.schema[c] for c in own] + [StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            bodies = b.column(b.num_columns - 1).to_pylist()
            for k in range(0, len(bodies), 64):
                parsed = [parse(h or "") for h in bodies[k : k + 64]]
                rows = [features(p) for p in parsed]
                odds = trees.log_odds(np.concatenate(rows))
                at = 0
                for p, r in zip(parsed, rows):
                    texts.append("\n".join(decode(p, odds[at : at + len(r)], trees.switch)))
                    at += len(r)
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(b.num_columns - 1)] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*own, "text", "n_chars"])

    return pages.select(*own, html).mapInArrow(run, schema)



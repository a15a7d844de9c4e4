"""A small tolerant DOM for main-text extraction: nodes, their text blocks and node features."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

import numpy as np

# A quote opens a value only after "="; any other, or one that nothing closes, is an ordinary character. The "/" of "/>" is a group of its own.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\s++|/(?!>)|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+)*+)(/?)>"
    r"|</?[a-zA-Z].*", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME = re.compile(r"[a-z]+|[0-9]+")
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())  # up to their end tag, all is text
DROPPED = frozenset("svg math object select option button template".split())  # without text, but with tags inside
FOREIGN = frozenset("svg math".split())  # "/>" closes a tag in here, and no element is raw
HTML_IN_FOREIGN = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
# An opening tag of these ends an open svg or math, as browsers have it.
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small "
    "span strong strike sub sup table tt u ul var".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An opening tag of the first kind ends open elements of the second, up to the third.
IMPLIED_END = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
               "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
SCOPE = frozenset("table td th caption html body".split())

# Words of class, id, role and itemprop values by what they tell about a node.
GOOD = frozenset("article content main post entry story text body prose blog news paragraph headline title maincontent articlebody".split())
BAD = {
    "menu": frozenset("nav navigation navbar menu breadcrumb breadcrumbs pagination pager tabs toc topbar toolbar".split()),
    "edge": frozenset("header masthead footer foot copyright colophon legal branding logo".split()),
    "side": frozenset("sidebar side aside widget related recommended popular trending rail secondary complementary".split()),
    "notice": frozenset("cookie cookies consent gdpr notice banner alert popup modal overlay dialog disclaimer toast".split()),
    "advert": frozenset("ad ads advert adverts advertisement sponsor sponsored promo promotion teaser outbrain taboola".split()),
    "form": frozenset("form search login signin signup register subscribe newsletter contact input".split()),
    "talk": frozenset("comment comments reply replies discussion disqus respond share social sharing follow like rating".split()),
}
TAG_KINDS = {"article": "good", "main": "good", "nav": "menu", "menu": "menu", "header": "edge", "footer": "edge", "aside": "side",
             "dialog": "notice", "form": "form", "fieldset": "form", "search": "form", "address": "edge"}
KINDS = ("good", *BAD)

FEATURES = (
    "chars_log", "words_log", "own_chars_log", "link_share", "share_of_page", "share_of_parent", "tags_per_char", "blocks_log",
    "chars_per_block_log", "list_share", "heading_share", "sentence_ends_per_word", "depth", "sibling_no", "siblings", "siblings_alike",
    "sibling_chars_log", "position_start", "position_end", "is_heading", "is_paragraph", "is_list", "is_table",
    *(f"own_{k}" for k in KINDS), *(f"above_{k}" for k in KINDS), *(f"below_{k}" for k in KINDS),
)


@dataclass
class Page:
    """Nodes in document order (a parent before its children) and the text blocks they own."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    kinds: list[frozenset] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # (node, text, characters in links)


def kinds_of(tag: str, attributes: str) -> frozenset:
    out = {TAG_KINDS[tag]} if tag in TAG_KINDS else set()
    if "=" in attributes:
        for m in ATTRIBUTE.finditer(attributes):
            names = NAME.findall((m[2] or m[3] or m[4] or "").lower())
            names += ["".join(p) for p in zip(names, names[1:])]
            for name in names:
                if name in GOOD:
                    out.add("good")
                for kind, known in BAD.items():
                    if name in known:
                        out.add(kind)
    return frozenset(out)


def parse(html: str) -> Page:
    """Nodes of block elements with their blocks of text; raw and dropped elements have none.

    A raw element without its end tag takes the rest of the page, as in HTML. A dropped one ends
    with its own end tag or that of an element around it.
    """
    page = Page()
    page.tag.append("#page")
    page.parent.append(-1)
    page.kinds.append(frozenset())
    stack: list[tuple[str, int, int]] = [("#page", 0, 0)]  # (tag, node that owns text here, place of the svg or math around, or 0)
    count: Counter[str] = Counter()  # open elements by tag: none is looked for on the stack in vain
    text: list[str] = []
    linked = links = dropped = 0

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join(unescape("".join(text)).split())
            if joined:
                page.blocks.append((stack[-1][1], joined, min(linked, len(joined))))
            text.clear()
        linked = 0

    def close(upto: int) -> None:
        nonlocal links, dropped
        while len(stack) > upto:
            tag = stack[-1][0]
            if tag in BLOCK and not dropped:
                flush()
            links -= tag == "a"
            dropped -= tag in DROPPED
            count[tag] -= 1
            stack.pop()

    def push(tag: str, node: int) -> None:
        around = len(stack) if tag in FOREIGN else 0 if tag in HTML_IN_FOREIGN else stack[-1][2]
        stack.append((tag, node, around))
        count[tag] += 1

    at = 0
    find = TOKEN.search
    while True:
        m = find(html, at)
        end = m.start() if m else len(html)
        if end > at and not dropped:
            piece = html[at:end]
            text.append(piece)
            if links:
                linked += len(" ".join(piece.split()))
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:  # comment, doctype, or a tag that the page's end cuts off
            continue
        tag = tag.lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1) if count[tag] else ():
                if stack[k][0] == tag:
                    close(k)
                    break
            continue
        around = stack[-1][2] if dropped else 0
        if around and tag in BREAKOUT:
            close(around)
            around = 0
        if m[4] and (around or tag in FOREIGN):
            continue
        if tag in RAW and not around:
            shut = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
            at = shut.start() if shut else len(html)
            continue
        if dropped or tag in DROPPED:
            if tag in ("option", "select", "button"):  # none holds another of its kind
                for k in range(len(stack) - 1, 0, -1) if count[tag] else ():
                    if stack[k][0] == tag:
                        close(k)
                        break
                    if stack[k][0] in SCOPE or stack[k][0] in DROPPED:
                        break
            if tag not in VOID:
                push(tag, stack[-1][1])
                dropped += tag in DROPPED
                links += tag == "a"
            continue
        if tag in VOID:
            if tag in BLOCK:
                flush()
            elif tag == "br":
                text.append(" ")
            continue
        if tag in BLOCK:
            flush()
            for k in range(len(stack) - 1, 0, -1) if count["p"] else ():  # an open paragraph ends where a block starts
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in SCOPE:
                    break
            if tag in IMPLIED_END:
                ends, stop = IMPLIED_END[tag]
                last = None
                for k in range(len(stack) - 1, 0, -1) if any(count[x] for x in ends) else ():
                    if stack[k][0] in stop:
                        break
                    if stack[k][0] in ends:
                        last = k
                if last is not None:
                    close(last)
            page.tag.append(tag)
            page.parent.append(stack[-1][1])
            page.kinds.append(kinds_of(tag, m[3] or ""))
            push(tag, len(page.tag) - 1)
        else:
            push(tag, stack[-1][1])
            links += tag == "a"
    close(1)
    flush()
    return page


def features(page: Page) -> np.ndarray:
    """One row of ``FEATURES`` for each node."""
    n = len(page.tag)
    parent = np.array(page.parent)
    own = np.zeros((n, 6))  # characters, words, link characters, blocks, list characters, heading characters
    ends = np.zeros(n)
    first, last = np.full(n, 1e18), np.full(n, -1.0)
    done = 0
    for node, text, linked in page.blocks:
        tag, size = page.tag[node], len(text)
        own[node] += (size, text.count(" ") + 1, linked, 1, size * (tag in ("li", "dt", "dd")), size * (tag in HEADINGS))
        ends[node] += text.count(". ") + text.endswith((".", "!", "?", "…", "。"))
        first[node] = min(first[node], done)
        done += size
        last[node] = max(last[node], done)
    total = own.copy()
    tags, below, depth = np.ones(n), np.zeros((n, len(KINDS))), np.zeros(n)
    mark = np.zeros((n, len(KINDS)))
    for i, kinds in enumerate(page.kinds):
        for k in kinds:
            mark[i, KINDS.index(k)] = 1
    ended = ends.copy()
    above = np.zeros((n, len(KINDS)))
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        p = parent[i]
        depth[i] = depth[p] + 1
        above[i] = np.maximum(above[p], mark[p])
        children[p].append(i)
    for i in range(n - 1, 0, -1):
        p = parent[i]
        total[p] += total[i]
        tags[p] += tags[i]
        ended[p] += ended[i]
        below[p] += np.maximum(below[i], mark[i])
        first[p], last[p] = min(first[p], first[i]), max(last[p], last[i])
    number, count, alike, beside = np.zeros(n), np.ones(n), np.zeros(n), np.zeros(n)
    for kids in children:
        size = len(kids)
        if size:
            around = total[kids, 0].sum()
            names: dict[str, int] = {}
            for i in kids:
                names[page.tag[i]] = names.get(page.tag[i], 0) + 1
            for k, i in enumerate(kids):
                number[i], count[i], alike[i] = k, size, names[page.tag[i]]
                beside[i] = (around - total[i, 0]) / max(1, size - 1)
    chars = np.maximum(total[:, 0], 1)
    tag = np.array(page.tag)
    up = np.maximum(parent, 0)
    columns = [
        np.log1p(total[:, 0]), np.log1p(total[:, 1]), np.log1p(own[:, 0]), total[:, 2] / chars, total[:, 0] / max(1, done),
        total[:, 0] / np.maximum(1, total[up, 0]), tags / chars, np.log1p(total[:, 3]), np.log1p(total[:, 0] / np.maximum(1, total[:, 3])),
        total[:, 4] / chars, total[:, 5] / chars, ended / np.maximum(1, total[:, 1]), depth, np.minimum(number, 50), np.minimum(count, 50),
        np.minimum(alike, 50), np.log1p(beside), np.minimum(first, done) / max(1, done), np.maximum(last, 0) / max(1, done),
        np.isin(tag, list(HEADINGS)), np.isin(tag, ["p", "pre", "blockquote"]), np.isin(tag, ["ul", "ol", "li", "dl", "dt", "dd"]),
        np.isin(tag, ["table", "tr", "td", "th"]), *mark.T, *above.T, *np.minimum(below, 5).T,
    ]
    return np.stack([np.asarray(c, np.float64) for c in columns], axis=1)


SWITCH = 10.0  # what it costs a node to have kept and dropped text, where no sample has set it


def decode(page: Page, scores: np.ndarray, switch: float = SWITCH) -> list[str]:
    """Blocks of the main text, by the labelling of the whole tree with the best total score.

    ``scores``: log-odds of each node that owns text. A node is kept with all below
    it, dropped with all below it, or left open to its children; so a kept node has no
    dropped ancestor or descendant, and the other way round. An open node costs
    ``switch`` if text comes to it from more than one side; one that only wraps
    another is free.
    """
    n = len(page.tag)
    weight = np.zeros(n)
    for node, text, _ in page.blocks:
        weight[node] += len(text) ** 0.5
    own = scores * weight
    keep = own.copy()  # all below kept; all dropped is its negative
    sides = (weight > 0).astype(np.int64)  # where the text of a node comes from: itself, and its children
    best_open = np.zeros(n)
    choice = np.zeros(n, np.int8)  # 1 keep, -1 drop, 0 open
    for i in range(n - 1, -1, -1):
        # its own text follows the node's score when the children decide for themselves
        opened = best_open[i] + abs(own[i]) - (switch if sides[i] > 1 else 0)
        choice[i] = 0 if opened > abs(keep[i]) + 1e-9 else (1 if keep[i] > 0 else -1)
        if i:
            p = page.parent[i]
            keep[p] += keep[i]
            sides[p] += sides[i] > 0
            best_open[p] += max(abs(keep[i]), opened)
    label = np.zeros(n, np.int8)
    for i in range(n):
        above = label[page.parent[i]] if i else 0
        label[i] = above or choice[i]
    return [text for node, text, _ in page.blocks if label[node] > 0 or (label[node] == 0 and own[node] > 0)]

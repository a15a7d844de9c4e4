"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash


def repeated_windows(texts, window):
    """For each sequence of tokens, a mask of tokens covered by a window that starts anywhere else too."""
    count = Counter(tuple(t[i : i + window]) for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        mask = [False] * len(t)
        for i in range(len(t) - window + 1):
            if count[tuple(t[i : i + window])] > 1:
                mask[i : i + window] = [True] * window
        out.append(mask)
    return out


def runs(mask):
    return sum(1 for i, m in enumerate(mask) if m and (i == 0 or not mask[i - 1]))


def op8(rows, window):
    """{doc row: (n_bytes, n_removed, n_spans, sha)}; rows are (doc_id, text)."""
    bodies = [(t or "").encode() for _, t in rows]
    out = []
    for (d, _), b, mask in zip(rows, bodies, repeated_windows(bodies, window)):
        kept = bytes(c for c, m in zip(b, mask) if not m)
        out.append((d, len(b), sum(mask), runs(mask), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def op4(rows, window):
    bodies = [(t or "").encode().split() for _, t in rows]
    out = []
    for (d, _), b, mask in zip(rows, bodies, repeated_windows(bodies, window)):
        kept = b" ".join(c for c, m in zip(b, mask) if not m)
        out.append((d, len(b), sum(mask), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def fingerprint(text, shingle=4):
    words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def linked(nodes, near):
    """Smallest member of each node's component under ``near``."""
    root = {}
    for n in nodes:
        if n in root:
            continue
        todo, group = [n], {n}
        while todo:
            u = todo.pop()
            for v in nodes:
                if v not in group and near(u, v):
                    group.add(v)
                    todo.append(v)
        for v in group:
            root[v] = group
    return root


def op2(rows, shingle=4, tau=4):
    fps = [(d, fingerprint(t, shingle)) for d, t in rows]
    groups = linked(sorted({f for _, f in fps}), lambda a, b: (a ^ b).bit_count() <= tau)
    ids = defaultdict(list)
    for d, f in fps:
        ids[f].append(d)
    out = []
    for d, f in fps:
        own = [x for g in groups[f] for x in ids[g] if x is not None]
        out.append((d, f"{f:016x}", min(own) if own else None))
    return sorted(out, key=str)


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return host.translate({c: c + 32 for c in range(65, 91)}), path


def url_rule(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def url_scores(urls, rules, order, strength):
    """Score of every (host, path) under models of all labelled URLs."""
    n = {c: Counter() for c in ("allow", "block")}
    total = {c: Counter() for c in n}
    pairs = [split_url(u) for u in urls]
    for host, path in pairs:
        rule = url_rule(host, path, rules)
        if rule:
            s = "\x02" * order + host + path + "\x03"
            for i in range(order, len(s)):
                for k in range(order + 1):
                    n[rule.verdict][s[i - k : i + 1]] += 1
                    total[rule.verdict][k, s[i - k : i]] += 1
    out = {}
    for host, path in set(pairs):
        s, score = "\x02" * order + host + path + "\x03", 0.0
        for i in range(order, len(s)):
            p = {}
            for c in n:
                p[c] = 1 / 256
                for k in range(order + 1):
                    p[c] = (n[c][s[i - k : i + 1]] + strength * p[c]) / (total[c][k, s[i - k : i]] + strength)
            score += math.log(p["allow"]) - math.log(p["block"])
        out[host, path] = score / (len(s) - order)
    return out


def byte_characters():
    """Character of a byte-level vocabulary -> byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


def json_tokenizer(plain=False):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = plain
    return t


@functools.cache
def json_tokenizer_once(plain=False):
    return json_tokenizer(plain)


def op13(rows):
    """(doc_id, n_tokens, sha of the ids, sha of the decoded text) by the tokenizers library alone."""
    t, out = json_tokenizer(), []
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        text = t.decode(ids, skip_special_tokens=False)
        out.append((d, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def token_spans(ids, tokens):
    out, at = [], 0
    for i, t in zip(ids, tokens):
        out.append((at, at + len(t), i))
        at += len(t)
    return out


def op11(rows):
    """Whole texts by both libraries; every pair of overlapping tokens is a link."""
    import public_tokenizers as P
    import sentencepiece

    a, known = json_tokenizer(plain=True), byte_characters()
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    a_bytes = lambda i: bytes(known[c] for c in a.id_to_token(i))
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode()
    count, found = Counter(), []
    for d, text in rows:
        a_ids = a.encode(" " + (text or ""), add_special_tokens=False).ids
        b_ids = b.encode(text or "")
        sides = [[f(i) for i in ids] for f, ids in ((a_bytes, a_ids), (b_bytes, b_ids))]
        if not text or any(b"".join(s) != (" " + text).encode() for s in sides):
            found.append((d, None, None, None))
            continue
        left, right = token_spans(a_ids, sides[0]), token_spans(b_ids, sides[1])
        links, begin = [], 0
        for s, e, i in left:
            while right[begin][1] <= s:
                begin += 1
            k = begin
            while k < len(right) and right[k][0] < e:
                links.append((i, right[k][2]))
                k += 1
        groups, i, j = [], 0, 0
        for at in sorted({e for _, e, _ in left} & {e for _, e, _ in right}):
            own = []
            for side, k in ((left, i), (right, j)):
                own.append([str(t) for _, e, t in side[k:] if e <= at] if len(side) < 500 else _until(side, k, at))
            i, j = i + len(own[0]), j + len(own[1])
            groups.append("|".join(",".join(x) for x in own))
        count.update(links)
        found.append((d, (len(left), len(right), len(groups), len(links)), links, ";".join(groups)))
    top = defaultdict(int)
    for (_, j), n in count.items():
        top[j] = max(top[j], n)
    out = []
    for d, sizes, links, groups in found:
        if sizes is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
        else:
            best = sum(count[x] == top[x[1]] for x in links)
            out.append((d, *sizes, best, sum(count[x] for x in links), hashlib.sha256(groups.encode()).hexdigest()))
    return sorted(out, key=str), {x: (n, n == top[x[1]]) for x, n in count.items()}


def _until(side, k, at):
    out = []
    while k < len(side) and side[k][1] <= at:
        out.append(str(side[k][2]))
        k += 1
    return out


def op12(rows, entries=64, parts=16, rounds=2, scale=256):
    """Plain search over Python integers; rows are (vec_id, embedding, label)."""
    kept = []
    for v, e, label in rows:
        if e is not None and all(x is not None and math.isfinite(x) for x in e):
            kept.append((v, [math.floor(scale * x) for x in e], label, list(e)))
    seeds = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[3]))[:entries]
    width = len(kept[0][1]) // parts
    cut = lambda v: [tuple(v[p * width : (p + 1) * width]) for p in range(parts)]
    books = [list(b) for b in zip(*[cut(r[1]) for r in seeds])]
    apart = lambda x, y: sum((p - q) ** 2 for p, q in zip(x, y))
    nearest = lambda x, book: min((apart(x, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        members = [defaultdict(list) for _ in books]
        for r in kept:
            for p, x in enumerate(cut(r[1])):
                members[p][nearest(x, books[p])[1]].append(x)
        for p, own in enumerate(members):
            for k, xs in own.items():
                books[p][k] = tuple(sum(c) // len(xs) for c in zip(*xs))
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    found, labels = [], Counter()
    for v, x, label, _ in kept:
        best = [nearest(y, b) for y, b in zip(cut(x), books)]
        found.append((v, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label))
        labels[label] += found[-1][2]
    return sorted(((v, code, error, labels[label], sha) for v, code, error, label in found), key=str)

"""Quotation linking: parsing, links, threads against a plain version, odd rows."""

from __future__ import annotations

import random
import time

import pytest

from strata.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("text,own,passages", [
    ("hello", "hello", []),
    ("> a\n> b\n\nreply", "reply", [(1, ["a", "b"])]),
    ("On Monday Ann wrote:\n> a\n>> deep\n> b\nmy answer", "my answer", [(1, ["a"]), (2, ["deep"]), (1, ["b"])]),
    ("> > nested\nx > y", "x > y", [(2, ["nested"])]),
    ("", "", []),
])
def test_parsing(text, own, passages):
    assert quotes.parse_message(text) == (own, passages)


def plain(rows):
    """{(conv, turn): (reply_to, thread)} by walking every conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        said, links = {}, {}
        own = sorted(((t, *quotes.parse_message(x or "")) for c, t, _, x in rows if c == conv), key=lambda r: r[0])
        for t, body, _ in own:
            for h in quotes.own_names(body):
                said.setdefault(h, t)
        for t, _, passages in own:
            found = []
            for k, (level, lines) in enumerate(passages):
                for by, name in ((0, quotes.named(quotes.normal(lines))), (1, quotes.named(max((quotes.normal([x]) for x in lines), key=len)))):
                    if name in said and said[name] < t:
                        found.append((level, by, k, said[name]))
            links[t] = min(found)[3] if found else None
        thread, turns = {}, sorted(links)
        for t, _, _ in own:
            to = links[t]
            thread[t] = [t] if to is None else thread[to] if turns.index(t) - turns.index(to) == 1 else thread[to] + [t]
            out[conv, t] = (to, thread[t])
    return out


def corpus():
    rng = random.Random(6)
    rows = []
    for conv in range(25):
        texts = []
        for turn in range(rng.randint(1, 14)):
            body = f"Message {conv} {turn} says {rng.randint(0, 10**9)}.\nAnd a second line {rng.randint(0, 10**9)}."
            if texts and rng.random() < 0.6:
                lines = rng.choice(texts).upper().split("\n")
                quote = rng.choice([lines, lines[:1], ["unknown words"], [lines[0], "never said"]])
                body = "On some day Bob wrote:\n" + "\n".join("> " + x for x in quote) + "\n" + rng.choice(["", ">> old\n"]) + body
            rows.append((conv, turn, "user", body))
            texts.append(quotes.parse_message(body)[0])
    return rows + [(100, 0, None, None), (100, 1, "user", "> nothing"), (101, 3, "user", "> me\nme")]


def test_links_and_threads_equal_the_plain_version(spark):
    rows = corpus()
    want = plain(rows)
    out = quotes.link(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.reply_to, list(r.thread)) == want[r.conv_id, r.turn], (r.conv_id, r.turn)
        assert r.text == quotes.parse_message({(c, t): x for c, t, _, x in rows}[r.conv_id, r.turn] or "")[0]
    assert sum(r.reply_to is not None for r in out) > 40 and max(len(r.thread) for r in out) > 2


def test_long_chains(spark):
    rows = [(1, 0, "u", "start 0")] + [(1, t, "u", f"> start {t - 1}\nstart {t}") for t in range(1, 60)]
    rows += [(2, 0, "u", "start 0")] + [(2, 2 * t, "u", f"> start {2 * t - 2}\nstart {2 * t}") for t in range(1, 20)]
    out = {(r.conv_id, r.turn): r for r in quotes.link(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert list(out[1, 59].thread) == [0] and out[1, 59].reply_to == 58
    assert list(out[2, 38].thread) == [0] and out[2, 38].reply_to == 36


def test_predecessors_across_gaps_and_partitions(spark):
    rng = random.Random(4)
    rows = [(c, t, "u", f"> own {c} {p}\nown {c} {t}") for c in range(12) for p, t in zip([None, *range(0, 400, 10)], range(0, 400, 10))]
    rows = [r for r in rows if r[1] % 3 or r[1] == 0]  # gaps: some reply to a message that is gone
    rng.shuffle(rows)
    want = plain(rows)
    out = quotes.link(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()
    assert {(r.conv_id, r.turn): (r.reply_to, list(r.thread)) for r in out} == want


def test_very_long_messages():
    body = "\n".join(["> quoted", "", "On Monday Ann wrote:", "plain"] * 50_000 + [""] * 200_000)
    begun = time.time()
    own, passages = quotes.parse_message(body)
    assert time.time() - begun < 20 and len(passages) == 50_000 and own.count("plain") == 50_000


def test_order_repeats_and_empty(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "u", "b"), (1, 2, "u", "> a\nc"), (1, 3, "u", "d"), (1, 1, "u", "b"), (None, 0, "u", "x"), (None, 4, "u", "> x\ny")]
    linked = quotes.link(spark.createDataFrame(rows, SCHEMA))
    assert linked.count() == 7
    ordered = [r.turn for r in quotes.reply_ordered(linked.where("conv_id = 1")).collect()]
    assert ordered == [0, 2, 1, 1, 3]
    assert {r.turn: r.reply_to for r in linked.where("conv_id IS NULL").collect()} == {0: None, 4: 0}
    assert quotes.link(spark.createDataFrame([], SCHEMA)).collect() == []
    extra = spark.createDataFrame([(1, 0, "t", "mine")], "conv_id long, turn long, text string, thread string")
    assert quotes.link(extra).columns == ["conv_id", "turn", "text", "reply_to", "thread"]

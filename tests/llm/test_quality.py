"""Quality rules: counts against plain regular expressions, line rules, odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from strata.llm import quality

SCHEMA = "doc_id long, text string"
WORD = r"[^\x20\x09-\x0D]+"


def counts(text):
    words = re.findall(WORD, text)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def rows():
    rng = random.Random(3)
    words = ["a", "bé", "c#", "ddd", "the", "x|y", "　", "\x85", "z\x00"]
    out = [(i, "".join(rng.choice(words) + rng.choice([" ", "\n", "\t", " \r\n", "  "]) for _ in range(rng.randint(0, 120)))) for i in range(80)]
    return out + [(90, None), (91, ""), (92, "\n \n"), (None, "w " * 60), out[4], (93, " ".join(f"w{k}" for k in range(200_000)))]


def test_counts_equal_regular_expressions(spark):
    data = rows()
    got = quality.line_first(spark.createDataFrame(data, SCHEMA).repartition(3)).collect()
    want = sorted(((d, *counts(t or "")) for d, t in data), key=str)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=str) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.n_lost_words <= 0.3 * r.n_words)


@pytest.mark.parametrize("line,fails", [
    ("Home", True), ("  Sign in >", True), ("News | Sport | Weather | Shop", True), ("### $$$ *** mix", True), ("... --- !!", True),
    ("All Rights Reserved 2020", True), ("We use cookies to improve this page.", True),
    ("Come home after the long day.", False), ("Fish & chips are nice on a long day at the sea.", False), ("Les.", False), ("Ünder öl", False)])
def test_line_rules(line, fails):
    assert quality.line_fails(line.encode(), quality.LineRules()) is fails


def test_failed_lines_go_and_heavy_losses_reject(spark):
    prose = "\n".join(f"Sentence w{k} x{k} tells{k} of y{k} something z{k} entirely{k}." for k in range(12))
    bad = "\n".join(f"$$$ %%% {k} ***" for k in range(40))
    docs = spark.createDataFrame([(1, "Menu\n" + prose), (2, prose + "\n" + bad)], SCHEMA)
    out = {r.doc_id: r for r in quality.line_first(docs).collect()}
    assert out[1].kept and out[1].clean_text == prose
    assert not out[2].kept and not out[2].base_failed


MENUS = [
    ("Startseite\nÜber uns\n\nKontakt\nImpressum\nDer Satz hier ist lang und bleibt stehen", {0, 1, 3, 4}),  # blank lines aside
    ("Accueil\nPlan du site\nNous contacter\nLa ligne finit ici.\nSuite", set()),  # three lines are no menu
    ("a\nb.\nc\nd\ne", set()),
    ("Roses are red,\nViolets are blue,\nSugar is sweet,\nAnd so are you.", set()),
    ("uno\ndos »\ntres”\ncuatro", {0, 1, 2, 3}), ("uno\ndos.»\ntres\ncuatro\ncinco…\nseis", set()), ("", set())]


@pytest.mark.parametrize("text,menu", MENUS)
def test_menus(text, menu):
    lines = text.encode().split(b"\n")
    assert quality.menu_lines(lines, [len(x.split()) for x in lines], quality.LineRules()) == menu


def test_link_lines():
    fails = lambda t: quality.line_fails(t.encode(), quality.LineRules())
    assert fails("http://a.b/c") and fails("siehe https://a.de www.b.de") and not fails("siehe https://a.de") and not fails("mehr auf seite www.b.de heute")


def test_verdicts_equal_sql_on_random_lines(spark):
    import duckdb
    import pandas as pd

    rng = random.Random(11)
    pool = ["Inicio", "Sobre nosotros", "Kontakt »", "Der Hund schläft heute lange im Garten.", "www.a.b", "siehe http://x.y z", "Ja.”", "…", "Home", "", "  ",
            "a | b | c | d", "Mehr dazu später:", "eins zwei drei vier", "eins zwei drei vier fünf", "\tMenü\r", "$$$", "we use cookies"]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    for i in range(300, 600):
        prose = [f"Wort{k} steht{k} in{k} Satz{k} nummer{k}." for k in range(rng.randint(11, 20))]
        links = [f"http://x.y/{k} www.z.de/{k} hier{k}" for k in range(rng.randint(0, 25))]
        docs.append((i, "\n".join([*prose, *rng.sample(pool, rng.randint(1, 18)), *links])))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    rel = con.sql(quality.oracle_sql())
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = quality.line_first(spark.createDataFrame(docs, SCHEMA)).select(*names).collect()
    assert rel.columns == names and sorted(map(tuple, got)) == sorted(rel.fetchall())
    assert 0 < sum(r.kept for r in got) < 300


def test_repeat_words_in_texts_with_many_words():
    words = [b"%d" % (k % 2_100_000) for k in range(2_100_000 + 10)]
    assert quality.repeat_words(words) == 20


def test_empty_and_clashing_columns(spark):
    assert quality.line_first(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([(1, "x", "mine", 5)], "doc_id long, text string, kept string, other long")
    r = quality.line_first(docs).collect()[0]
    assert r.kept is False and r.other == 5 and r.text == "x"

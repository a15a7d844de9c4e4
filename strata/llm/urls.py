"""URL filter (operator 10): host/path rules, else a character language-model ratio.

Two smoothed variable-order Markov models over the characters of host and path
are counted, one over all accepted and one over all rejected URLs (those that a
rule decides). A URL without a rule is judged by the length-normalised
log-likelihood difference against a threshold calibrated on labelled URLs that
are scored by models without their own fold.

Counts are taken per distinct (host, path) with its number of rows, so a URL
that fills a third of the table is counted once with its weight. Nothing is
collected but a histogram of at most ``2 * BINS + 1`` bins, and no table is
broadcast: by the size of their compressed files Spark takes tables of grams for
small that fill the driver once unpacked, so the joins are merge joins.

Defined cases: a null url, or one without ``://``, has empty host and path; its
score is that of the end sign alone. Where one class has no URL the threshold is
0. Repeated rows get the same verdict each. Extra columns pass through unless
they are named like an output column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch

START, END = "\u0002", "\u0003"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BINS = 2000  # histogram bins of 0.01 on either side of zero
VARIANTS = ("all", "but0", "but1")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):  # the longest is tested first: it is put outermost
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def gram_ratios(grams: DataFrame, order: int, strength: float, scratch: Scratch) -> DataFrame:
    """Log-probability ratio of the last character of every ``order + 1``-gram, for each model variant.

    ``grams``: (gram, a_<variant>, r_<variant>) counts. Probabilities are
    interpolated from the shortest context up: p_n = (c_n + s * p_{n-1}) / (C_n + s).
    Each level is saved, so that no plan holds more than one.
    """
    cols = [f"{c}_{v}" for v in VARIANTS for c in "ar"]
    best = None
    for n in range(1, order + 2):
        level = grams.groupBy(F.substring("gram", order + 2 - n, n).alias("g")).agg(*[F.sum(c).alias(c) for c in cols])
        context = level.groupBy(F.substring("g", 1, n - 1).alias("x")).agg(*[F.sum(c).alias(f"t_{c}") for c in cols])
        level = level.withColumn("x", F.substring("g", 1, n - 1)).join(context.hint("merge"), "x")
        if best is None:
            below = {c: F.lit(1.0 / 256) for c in cols}
        else:
            level = level.withColumn("y", F.substring("g", 2, n - 1)).join(best.withColumnRenamed("g", "y").hint("merge"), "y")
            below = {c: F.col(f"p_{c}") for c in cols}
        best = scratch.save(level.select("g", *[((F.col(c) + strength * below[c]) / (F.col(f"t_{c}") + strength)).alias(f"p_{c}") for c in cols]))
    ratio = [(F.log(F.col(f"p_a_{v}")) - F.log(F.col(f"p_r_{v}"))).cast("decimal(12,8)").alias(f"d_{v}") for v in VARIANTS]
    return best.select(F.col("g").alias("gram"), *ratio)


def calibrate(scored: DataFrame) -> float:
    """Threshold with the best balanced accuracy on (label, n, score) rows: the middle of the best range."""
    b = F.greatest(F.lit(-BINS), F.least(F.lit(BINS), F.floor(F.col("score") * 100))).alias("b")
    rows = scored.groupBy(b).agg(
        F.sum(F.when(F.col("label") == "allow", F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("label") == "block", F.col("n")).otherwise(0)).alias("r"),
    ).collect()
    a, r = sum(x.a for x in rows), sum(x.r for x in rows)
    if not a or not r:
        return 0.0
    at = {int(x.b): x for x in rows}
    best, lo, hi, a_left, r_left = -1, 0, 0, 0, 0
    for k in range(-BINS, BINS + 2):  # everything below bin k is blocked
        gain = (a - a_left) * r + r_left * a
        if gain > best:
            best, lo, hi = gain, k, k
        elif gain == best and hi == k - 1:
            hi = k
        if k in at:
            a_left, r_left = a_left + at[k].a, r_left + at[k].r
    return (lo + hi) / 200.0


def filter_urls(pages: DataFrame, rules: list[Rule], url: str = "url", order: int = 5, strength: float = 2.0) -> DataFrame:
    """Rows of ``pages`` with host, path, rule, verdict, the model's score and its threshold."""
    host, path = split_url(F.col(url))
    added = ("host", "path", "rule", "verdict", "score", "threshold")
    rows = pages.select(*[c for c in pages.columns if c not in added], host.alias("host"), path.alias("path"))
    name, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    scratch = Scratch(pages.sparkSession, "urls")
    urls = scratch.save(rows.groupBy("host", "path").agg(F.count("*").alias("n")).withColumn("label", verdict))
    text = F.concat("host", "path")
    padded = F.concat(F.lit(START * order), text, F.lit(END))
    fold = F.pmod(F.xxhash64(text), F.lit(2))
    spread = urls.select("host", "path", "label", "n", fold.alias("fold"), padded.alias("s")).withColumn(
        "gram", F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - order), lambda i: F.substring(F.col("s"), i, F.lit(order + 1)))))

    def weight(label: str, but: int | None) -> Column:
        test = F.col("label") == label
        return F.sum(F.when(test if but is None else test & (F.col("fold") != but), F.col("n")).otherwise(0))

    counts = spread.groupBy("gram").agg(
        *[weight(label, but).alias(f"{c}_{v}") for v, but in zip(VARIANTS, (None, 0, 1)) for c, label in (("a", "allow"), ("r", "block"))])
    ratios = scratch.save(gram_ratios(scratch.save(counts), order, strength, scratch))
    mine = F.when(F.col("fold") == 0, F.col("d_but0")).otherwise(F.col("d_but1"))
    scored = scratch.save(
        spread.join(ratios.hint("merge"), "gram").groupBy("host", "path").agg(
            F.first("label").alias("label"), F.first("n").alias("n"),
            (F.sum("d_all").cast("double") / F.count("*")).alias("score"), (F.sum(mine).cast("double") / F.count("*")).alias("cross")))
    threshold = calibrate(scored.where("label IS NOT NULL").select("label", "n", F.col("cross").alias("score")))
    judged = scored.select("host", "path", "score", F.lit(threshold).alias("threshold"))
    out = rows.join(judged.hint("merge"), ["host", "path"]).withColumn("rule", name)
    model = F.when(F.col("score") >= F.col("threshold"), "allow").otherwise("block")
    return out.withColumn("verdict", F.coalesce(verdict, model))

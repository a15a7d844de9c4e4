"""Marts by deltas equal marts made anew, read touched periods only, and survive a run that dies anywhere."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import incremental, marts
from strata.operators.incremental import IncrementalMart, MartSpec

SCHEMA = "report_period string, op string, line int, price decimal(18,2), n int, at int"
SPEC = MartSpec(["report_period", "op"], "facts", {"total": "price", "n": "n"}, {"mean": "price"})
KEYS = ["report_period", "op", "line"]


def batch(rng, number, periods=("2024-01", "2024-02", "2024-03"), size=25):
    money = lambda: rng.choice([None, Decimal(rng.randint(-500, 5000)) / 100])
    return [(rng.choice(periods), rng.choice(["A", "B", None]), rng.randint(1, 4), money(), rng.choice([None, 1, 2]), number * 100 + k) for k in range(size)]


def shares(rows):
    return marts.add_shares(rows, ["report_period"], {"facts": "share"}, cast_to={"facts": "decimal(20,0)"})


def brute(batches, null_safe):
    """Facts after all upserts, then the mart, in plain Python."""
    facts, loose = {}, []
    for rows in batches:
        latest = {}
        for r in rows:
            if r[:3] not in latest or latest[r[:3]][5] < r[5]:
                latest[r[:3]] = r
        for k, r in latest.items():
            if None in k and not null_safe:
                loose.append(r)
            else:
                facts[k] = r
    out = {}
    for r in [*facts.values(), *loose]:
        out.setdefault(r[:2], []).append(r)
    size = {}
    for (p, _), rows in out.items():
        size[p] = size.get(p, 0) + len(rows)
    table = {}
    for k, rows in out.items():
        prices, ns = [r[3] for r in rows if r[3] is not None], [r[4] for r in rows if r[4] is not None]
        mean = float(sum(prices) / len(prices)) if prices else None
        table[k] = (len(rows), sum(prices) if prices else None, sum(ns) if ns else None, mean and round(mean, 6), round(len(rows) / size[k[0]] * 100, 4))
    return table


def found(mart):
    rows = mart.collect()
    table = {(r.report_period, r.op): (r.facts, r.total, r.n, r.mean and round(float(r.mean), 6), float(r.share)) for r in rows}
    assert len(table) == len(rows)
    return table


@pytest.mark.parametrize("null_safe", [False, True])
def test_random_batches_equal_a_mart_made_anew(spark, scratch, null_safe):
    rng = random.Random(5)
    kept = IncrementalMart(spark, scratch, SPEC, KEYS, ["at"], shares, null_safe)
    batches = []
    for k in range(5):
        periods = [("2024-01", "2024-02", "2024-03"), ("2024-02",), ("2024-03", "2025-12")][k % 3]
        batches.append(batch(rng, k, periods))
        assert kept.apply(f"b{k}", spark.createDataFrame(batches[-1], SCHEMA)) == sorted({r[0] for r in batches[-1]})
        if k in (1, 4):
            assert found(kept.mart()) == brute(batches, null_safe)


def test_other_periods_are_neither_read_nor_written(spark, scratch):
    rng = random.Random(6)
    kept = IncrementalMart(spark, scratch, SPEC, KEYS, ["at"], shares)
    kept.apply("b0", spark.createDataFrame(batch(rng, 0), SCHEMA))
    files = lambda name: {f for f in spark.read.parquet(f"{scratch}/{name}").inputFiles() if "2024-02" not in f}
    before = files("facts"), files("mart")
    rows = spark.createDataFrame(batch(rng, 1, ["2024-02"]), SCHEMA)
    assert kept.apply("b1", rows) == ["2024-02"]
    assert (files("facts"), files("mart")) == before
    plan = kept._read("facts", rows.schema, ["2024-02"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-02" in plan.split("PartitionFilters", 1)[1]


@pytest.mark.parametrize("dies_at", ["log", "stage", "facts", "mart", "applied"])
def test_a_batch_that_died_is_finished_by_the_next_call(spark, scratch, monkeypatch, dies_at):
    rng = random.Random(7)
    batches = [batch(rng, k, ("2024-01", "2024-02")) for k in range(2)]
    frames = [spark.createDataFrame(b, SCHEMA) for b in batches]
    kept = IncrementalMart(spark, scratch, SPEC, KEYS, ["at"], shares)
    kept.apply("b0", frames[0])
    write = IncrementalMart._write

    def dying(self, df, name, swap=False):
        if name.startswith(dies_at):
            raise RuntimeError("lost")
        write(self, df, name, swap)
        if dies_at == "applied" and name == "mart":
            raise RuntimeError("lost")

    monkeypatch.setattr(IncrementalMart, "_write", dying)
    with pytest.raises(RuntimeError, match="lost"):
        kept.apply("b1", frames[1])
    monkeypatch.setattr(IncrementalMart, "_write", write)
    again = IncrementalMart(spark, scratch, SPEC, KEYS, ["at"], shares)
    assert again.apply("b1", frames[1]) == ["2024-01", "2024-02"]
    assert found(again.mart()) == brute(batches, False)
    again.apply("b0", frames[0])  # done long ago: passed over
    assert found(again.mart()) == brute(batches, False)


def test_refusals_and_empty_batches(spark, scratch):
    with pytest.raises(ValueError, match="business key"):
        IncrementalMart(spark, scratch, SPEC, ["op", "line"], ["at"])
    with pytest.raises(ValueError, match="floating point"):
        SPEC.delta(spark.createDataFrame([], SCHEMA).withColumn("price", F.lit(1.0)).withColumn(incremental.SIGN, F.lit(1)))
    kept = IncrementalMart(spark, scratch, SPEC, KEYS, ["at"], shares)
    with pytest.raises(ValueError, match="without report_period"):
        kept.apply("b0", spark.createDataFrame([(None, "A", 1, None, 1, 1)], SCHEMA))
    rows = spark.createDataFrame([("2024-01", "A", 1, Decimal("1.10"), 1, 1)], SCHEMA)
    kept.apply("b1", rows)
    assert kept.apply("b2", rows.limit(0)) == []
    kept.apply("b3", rows)
    assert [(r.facts, r.total, r.n) for r in kept.mart().collect()] == [(1, Decimal("1.10"), 1)]

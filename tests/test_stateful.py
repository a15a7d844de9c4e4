"""Stateful registry and alerts: any cut of the actions gives the same state; each alert is raised once."""

from __future__ import annotations

import random

import pytest

from strata.streaming import stateful

COLUMNS = [c.split()[0] for c in stateful.ACTIONS.split(", ")]


def drawn(seed: int, n: int = 120):
    rng, rows = random.Random(seed), []
    for k in range(n):
        action = rng.choice(["seen", "seen", "review"])
        status = rng.choice(["resolved", "acknowledged", "false_positive"]) if action == "review" else None
        rows.append((f"f{rng.randint(0, 14)}", k // 2, k, action, status, rng.choice(["qos", "revenue"]), f"c{k}", rng.choice(["critical", "warning"]), "2025-01", f"r{k % 3}"))
    return rows


def plain(rows):
    state = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        after = stateful.applied(state.get(r[0]), dict(zip(COLUMNS, r)))
        if after is not None:
            state[r[0]] = after
    return state


def test_upsert_rules():
    seen = dict(zip(COLUMNS, ("f", 5, 0, "seen", None, "qos", "c", "critical", "2025-01", "r")))
    review = lambda s, at: seen | {"action": "review", "status": s, "at": at}
    one = stateful.applied(None, seen)
    assert (one["status"], one["detected_at"], one["resolved_at"]) == ("open", 5, None)
    two = stateful.applied(stateful.applied(one, review("resolved", 7)), seen | {"at": 9})
    assert (two["status"], two["detected_at"], two["resolved_at"]) == ("open", 9, 7)
    assert stateful.applied(stateful.applied(one, review("acknowledged", 7)), seen)["status"] == "acknowledged"
    assert stateful.applied(None, review("resolved", 7)) is None


@pytest.mark.parametrize("seed,parts", [(1, 1), (1, 4), (2, 7)])
def test_any_cut_gives_the_same_registry(spark, scratch, seed, parts):
    rows = drawn(seed)
    size = -(-len(rows) // parts)
    for k in range(0, len(rows), size):
        spark.createDataFrame(rows[k : k + size], stateful.ACTIONS).coalesce(1).write.parquet(f"{scratch}/actions/p{k:04d}")
        if k // size == parts // 2:  # a run in between: state is carried over
            stateful.run_registry(spark, f"{scratch}/actions", f"{scratch}/run", files_per_batch=1)
    out = stateful.run_registry(spark, f"{scratch}/actions", f"{scratch}/run", files_per_batch=1)
    got = {r.event_fingerprint: {c: r[c] for c in stateful.EVENT_COLUMNS} for r in out.collect()}
    assert got == {k: {c: v[c] for c in stateful.EVENT_COLUMNS} for k, v in plain(rows).items()}


def test_events_of_a_bucket_are_one_value(spark, scratch, monkeypatch):
    """calls for state are made by bucket, not by fingerprint; a null fingerprint is one too."""
    monkeypatch.setattr(stateful, "BUCKETS", 2, raising=False)
    rows = drawn(3, 200) + [(None, k, k, "seen", None, "qos", f"c{k}", "critical", "2025-01", "r0") for k in (7, 150)]
    rows += [(f"g{k}", 5, k, "seen", None, "qos", "c", "warning", "2025-01", None) for k in range(300)]
    want = plain(rows)
    for k, part in enumerate([[r for r in rows if r[1] < 40], [r for r in rows if r[1] >= 40]]):
        spark.createDataFrame(part, stateful.ACTIONS).coalesce(1).write.parquet(f"{scratch}/actions/p{k}")
        out = stateful.run_registry(spark, f"{scratch}/actions", f"{scratch}/run")
    got = {r.event_fingerprint: {c: r[c] for c in stateful.EVENT_COLUMNS} for r in out.collect()}
    assert got == {k: {c: v[c] for c in stateful.EVENT_COLUMNS} for k, v in want.items()} and None in got
    state = spark.read.format("statestore").option("stateVarName", "events").load(f"{scratch}/run/_registry")
    assert state.count() == 2


def test_three_runs_raise_each_alert_once(spark, scratch):
    limits = {("qos", "critical"): 3, ("revenue", "critical"): 2}
    seen = lambda run, at, n, domain: [(f"{domain}{k}", at, k, "seen", None, domain, "c", "critical", "2025-01", run) for k in range(n)]
    runs = [
        seen("r1", 1, 4, "qos") + seen("r1", 1, 1, "revenue"),
        seen("r2", 2, 4, "qos") + seen("r2", 2, 1, "revenue"),  # the same events again
        seen("r3", 3, 5, "qos") + seen("r3", 3, 2, "revenue"),
    ]
    notices = []
    for k, rows in enumerate(runs):
        spark.createDataFrame(rows, stateful.ACTIONS).coalesce(1).write.parquet(f"{scratch}/actions/r{k}")
        stateful.run_registry(spark, f"{scratch}/actions", f"{scratch}/run")
        found = stateful.run_alerts(spark, f"{scratch}/run", limits).collect()
        notices.append(sorted((r.domain, r.event_count, r.notice) for r in found))
    assert notices == [[("qos", 4, 1)], [("qos", 4, 1)], [("qos", 4, 1), ("revenue", 2, 1)]]
    # resolved below the threshold, then back: raised a second time
    resolved = [(f"qos{k}", 4, k, "review", "resolved", None, None, None, None, None) for k in range(4)]
    for k, rows in (("s", resolved), ("t", seen("r4", 5, 4, "qos"))):
        spark.createDataFrame(rows, stateful.ACTIONS).coalesce(1).write.parquet(f"{scratch}/actions/{k}")
        stateful.run_registry(spark, f"{scratch}/actions", f"{scratch}/run")
        found = stateful.run_alerts(spark, f"{scratch}/run", limits)
    assert sorted((r.domain, r.event_count, r.notice) for r in found.collect()) == [("qos", 4, 1), ("qos", 5, 2), ("revenue", 2, 1)]

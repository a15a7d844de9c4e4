"""Upsert, events lifecycle, alerts, audit and series operators on small fixtures."""

from __future__ import annotations

import hashlib
import math
from decimal import Decimal

from pyspark.sql import functions as F

from strata.operators import alerts, audit, events, marts, series, upsert
from strata.operators.joins import outer_merge


def test_latest_per_key_and_merge_are_deterministic_and_idempotent(spark):
    rows = [(1, "a", 10, "x"), (1, "a", 12, "y"), (1, "a", 12, "z"), (2, None, 5, "w"), (2, None, 7, "v")]
    df = spark.createDataFrame(rows, "k int, k2 string, ts int, v string")
    latest = {(r.k, r.k2): (r.ts, r.v) for r in upsert.latest_per_key(df, ["k", "k2"], ["ts"]).collect()}
    assert latest == {(1, "a"): (12, "z"), (2, None): (7, "v")}
    existing = spark.createDataFrame([(1, "a", 1, "old"), (3, "b", 1, "keep"), (2, None, 1, "null-key")], df.schema)
    once = upsert.merge(existing, df, ["k", "k2"], null_safe=True, order=["ts"])
    twice = upsert.merge(once, df, ["k", "k2"], null_safe=True, order=["ts"])
    a = sorted(map(tuple, once.collect()), key=str)
    assert a == sorted(map(tuple, twice.collect()), key=str)
    assert len(a) == 3 and (3, "b", 1, "keep") in a and (2, None, 7, "v") in a


def test_upsert_table_replaces_only_touched_partitions(spark, scratch):
    path = f"{scratch}/silver"
    first = spark.createDataFrame([("2025-01", "A", 1), ("2025-02", "B", 2)], "p string, k string, v int")
    upsert.upsert_table(spark, path, first, ["p", "k"], partition_by="p")
    batch = spark.createDataFrame([("2025-02", "B", 20), ("2025-02", "C", 3)], first.schema)
    out = upsert.upsert_table(spark, path, batch, ["p", "k"], partition_by="p")
    got = sorted((r.p, r.k, r.v) for r in out.collect())
    assert got == [("2025-01", "A", 1), ("2025-02", "B", 20), ("2025-02", "C", 3)]
    again = upsert.upsert_table(spark, path, batch, ["p", "k"], partition_by="p")
    assert sorted((r.p, r.k, r.v) for r in again.collect()) == got


def _anomalies(spark, rows):
    schema = ("domain string, operator_id string, service_segment string, report_period string, region_code string, "
              "source_table string, source_id string, bronze_id string, anomaly_code string, changed_fields string, "
              "observed_value decimal(22,6), raw_payload string")
    return spark.createDataFrame(rows, schema)


def test_fingerprint_severity_and_lifecycle(spark):
    a = _anomalies(spark, [
        ("revenue", "OPA01", "mobile", "2025-03", None, "silver.revenue", "s1", "b1", "usf_rate_high", None, Decimal(5), '{"x": 1}'),
        ("qos", "OPA01", "mobile", "2025-03", "BZV", "silver.qos", "s2", "b2", None, '["a"]', Decimal(1), "{}"),
    ])
    n = {r.bronze_id: r for r in events.normalize(a).collect()}
    assert n["b1"].event_fingerprint == hashlib.md5(b"revenue:b1:usf_rate_high").hexdigest()
    assert n["b1"].severity == "critical" and n["b2"].severity == "warning"
    assert n["b2"].event_code == "synthetic_anomaly" and n["b2"].event_fingerprint == hashlib.md5(b"qos:b2:unknown").hexdigest()
    assert '"changed_fields":[]' in n["b1"].metadata and '"raw_payload":{"x":1}' in n["b1"].metadata

    reg, captured = events.capture_events(a, None, "r1", "2025-04-01 00:00:00")
    assert captured.count() == 2 and {r.status for r in reg.collect()} == {"open"}
    reg = events.resolve(reg, reg.filter(F.col("bronze_id") == "b1"), "fixed", "2025-04-02 00:00:00")
    ack = reg.withColumn("status", F.when(F.col("bronze_id") == "b2", "acknowledged").otherwise(F.col("status")))
    again, _ = events.capture_events(a, ack, "r2", "2025-05-01 00:00:00")
    st = {r.bronze_id: r for r in again.collect()}
    assert st["b1"].status == "open" and st["b1"].resolved_at is not None  # reopened, resolved_at kept
    assert st["b2"].status == "acknowledged" and st["b2"].detected_by_run_id == "r2"


def test_marker_key_with_json_null_is_found(spark):
    silver = spark.createDataFrame([("b1", "s1", "OPA01", "mobile", "2025-03", "BZV", Decimal(3))],
                                   "bronze_id string, silver_id string, operator_id string, service_segment string, "
                                   "report_period string, region_code string, arpu_xaf decimal(10,2)")
    bronze = spark.createDataFrame([("b1", '{"_synthetic_anomaly": null}', None)],
                                   "bronze_id string, _raw_payload string, _loaded_at timestamp")
    rows = events.marker_rows(silver, bronze, "subscribers", F.col("arpu_xaf"), "silver.subscribers").collect()
    assert len(rows) == 1 and rows[0].anomaly_code is None


def test_alert_thresholds(spark):
    existing = alerts.thresholds_df(spark, [("revenue", "critical", 2, True), ("qos", "warning", 1, False)])
    t = alerts.ensure_thresholds(existing, alerts.thresholds_df(spark))
    got = {(r.domain, r.severity): r.event_count_threshold for r in t.collect()}
    assert got[("revenue", "critical")] == 2 and got[("qos", "critical")] == 10 and len(got) == 7
    ev = spark.createDataFrame(
        [("e1", "revenue", "critical", "open", "2025-03"), ("e2", "revenue", "critical", "acknowledged", "2025-03"),
         ("e3", "revenue", "critical", "resolved", "2025-03"), ("e4", "qos", "warning", "open", "2025-03")],
        "event_id string, domain string, severity string, status string, report_period string")
    a = alerts.evaluate_alerts(t, ev, "2025-03").collect()
    assert [(r.domain, r.severity, r.event_count, r.threshold_value) for r in a] == [("revenue", "critical", 2, 2)]
    routed = alerts.route_alerts(alerts.evaluate_alerts(t, ev), alerts.routing_df(spark)).first()
    assert routed.primary_owner == "Data platform on-call"


def test_period_status_and_decisions(spark):
    spine = series.period_spine(spark, "2025-01", "2025-03")
    a = spark.createDataFrame([("2025-01",), ("2025-02",)], "report_period string")
    b = spark.createDataFrame([("2025-01",)], "report_period string")
    counts = audit.period_counts({"a": a, "b": b}, spine)
    st = {r.report_period: r for r in audit.generation_decision(audit.classify_periods(counts, 2)).collect()}
    assert (st["2025-01"].period_status, st["2025-01"].action) == ("loaded", "skip")
    assert st["2025-02"].period_status == "partial" and st["2025-02"].reason == (
        "Refusing to auto-generate 2025-02: bronze already has partial data for domains ['a']. Clean up or handle manually.")
    assert (st["2025-03"].period_status, st["2025-03"].action) == ("empty", "proceed")


def test_run_health_labels(spark):
    m = spark.createDataFrame([(1, 0, 0), (0, 1, 0), (0, 0, 2), (0, 0, 0)], "r int, a int, e int")
    got = [r.h for r in m.select(marts.run_health_label("r", "a", "e").alias("h")).collect()]
    assert got == ["attention", "attention", "watch", "healthy"]


def test_outer_merge_forms_agree_and_keep_null_keys_apart(spark):
    x = spark.createDataFrame([("p1", "o1", 1), (None, "o2", 2)], "p string, o string, x int")
    y = spark.createDataFrame([("p1", "o1", 10), (None, "o2", 20), ("p2", "o3", 30)], "p string, o string, y int")
    u = sorted(map(tuple, outer_merge([("x", x), ("y", y)], ["p", "o"], "union").collect()), key=str)
    j = sorted(map(tuple, outer_merge([("x", x), ("y", y)], ["p", "o"], "join").select("p", "o", "x", "y").collect()), key=str)
    assert u == j and len(u) == 4


def _interp_py(anchors: dict[int, int], year: int, month: int) -> int:
    """Brute-force reference of the anchor rule on integer units (half-up)."""
    def rnd(num, den):
        return (2 * num + den) // (2 * den)
    if year in anchors:
        if year - 1 not in anchors:
            return anchors[year]
        return rnd(anchors[year - 1] * (12 - month) + anchors[year] * month, 12)
    ys = sorted(anchors)
    if year < ys[0]:
        return anchors[ys[0]]
    if year > ys[-1]:
        return anchors[ys[-1]]
    lo = max(y for y in ys if y < year)
    up = min(y for y in ys if y > year)
    return rnd(anchors[lo] * (up - year) + anchors[up] * (year - lo), up - lo)


def test_interpolation_matches_brute_force(spark):
    anchors = {2019: 100000, 2020: 130000, 2023: 70000}
    a = spark.createDataFrame([("k", y, Decimal(v) / 100) for y, v in anchors.items()], "key string, year int, value decimal(20,2)")
    t = spark.createDataFrame([("k", y, m) for y in range(2017, 2026) for m in range(1, 13)], "key string, year int, month int")
    got = {(r.year, r.month): r.interpolated for r in series.interpolate_anchors(a, t, ["key"]).collect()}
    for (y, m), v in got.items():
        assert v == Decimal(_interp_py(anchors, y, m)) / 100, (y, m)


def test_allocation_and_seasonality(spark):
    df = spark.createDataFrame([("g", 100, 1), ("g", 100, 2), ("g", 100, 0), ("h", 7, 0)], "g string, total int, w int")
    got = sorted((r.g, r.w, r.allocated) for r in series.allocate(df, "total", "w", ["g"]).collect())
    assert got == [("g", 0, 0), ("g", 1, 33), ("g", 2, 66), ("h", 0, 0)]
    s = spark.range(1, 13).select(F.col("id").alias("m"), series.seasonal_factor("m").alias("f")).collect()
    f = {r.m: r.f for r in s}
    assert math.isclose(f[12], 1.05) and math.isclose(f[6], 0.95) and f[12] == max(f.values())

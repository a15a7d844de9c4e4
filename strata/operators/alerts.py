"""Threshold alerts on open quality events, defaults, dedup and routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import stable_id
from ..session import small_table

# Default thresholds and routing policy.
DEFAULT_THRESHOLDS = (
    ("subscribers", "critical", 10, True),
    ("traffic_voice", "critical", 10, True),
    ("traffic_sms", "critical", 10, True),
    ("traffic_internet", "critical", 10, True),
    ("qos", "critical", 10, True),
    ("revenue", "critical", 10, True),
)
ALERT_CODE = "quality_events_threshold_exceeded"
ROUTING = (
    ("critical", "Data platform on-call", "Analytics lead"),
    ("warning", "Analytics lead", "Domain steward"),
)
OPEN_STATUSES = ("open", "acknowledged")
THRESHOLD_SCHEMA = "domain string, severity string, event_count_threshold int, enabled boolean"


def thresholds_df(spark: SparkSession, rows=DEFAULT_THRESHOLDS) -> DataFrame:
    df = small_table(spark, list(rows), THRESHOLD_SCHEMA)
    return df.select(stable_id(F.lit("threshold"), "domain", "severity").alias("threshold_id"), "*")


def ensure_thresholds(existing: DataFrame, defaults: DataFrame) -> DataFrame:
    """Insert defaults whose (domain, severity) is absent; never overwrite."""
    missing = defaults.join(existing.select("domain", "severity"), ["domain", "severity"], "left_anti")
    return existing.unionByName(missing.select(*existing.columns))


def evaluate_alerts(thresholds: DataFrame, events: DataFrame, period: str | None = None) -> DataFrame:
    """Enabled thresholds whose open/acknowledged event count reaches the limit.

    Events are pre-aggregated to (domain, severity, period) counts before the
    join: the count is additive, so this equals counting over the left join,
    while a hot (domain, severity) pair never funnels raw events into one task.
    ``period=None`` evaluates every period present in the events.
    """
    e = events.filter(F.col("status").isin(*OPEN_STATUSES))
    if period is not None:
        e = e.filter(F.col("report_period") == F.lit(period))
    counted = e.groupBy("domain", "severity", "report_period").agg(F.count("event_id").alias("event_count"))
    t = thresholds.filter(F.col("enabled")).select("domain", "severity", "event_count_threshold")
    j = t.join(counted, ["domain", "severity"], "left")
    out = j.select(
        F.lit(ALERT_CODE).alias("alert_code"),
        "severity",
        "domain",
        (F.lit(period) if period is not None else F.col("report_period")).cast("string").alias("report_period"),
        F.coalesce(F.col("event_count"), F.lit(0)).cast("bigint").alias("event_count"),
        F.col("event_count_threshold").alias("threshold_value"),
    )
    return out.filter(F.col("event_count") >= F.col("threshold_value")).orderBy("domain", "severity", "report_period")


def routing_df(spark: SparkSession) -> DataFrame:
    return small_table(spark, list(ROUTING), "severity string, primary_owner string, secondary_owner string")


def route_alerts(alerts: DataFrame, routing: DataFrame) -> DataFrame:
    """One alert per (alert_code, domain, period) — the highest event count —
    joined to its owners by severity."""
    best = alerts.groupBy("alert_code", "domain", "report_period").agg(
        F.max(F.struct("event_count", "severity", "threshold_value")).alias("_a")
    )
    deduped = best.select("alert_code", "domain", "report_period", "_a.severity", "_a.event_count", "_a.threshold_value")
    return deduped.join(routing, "severity", "left")

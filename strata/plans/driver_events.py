"""Quality events, lifecycle, alerts and routing on the driver ``events`` table.

Analog: every driver event is a marker row of a silver fact. Its type picks
the submission domain and the anomaly code; ``props`` is the raw payload.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import stable_id
from ..functions.json import has_key
from ..operators import alerts, events, marts
from ..session import ensure_checkpoint_dir, shared_scratch
from ..streaming import stateful
from .registry import ORACLES, query
from .tables import event_facts, money, table

# Fixed analog mapping: event type -> (domain, anomaly code); signup carries no code.
TYPE_MAP = (
    ("error", "revenue", "component_sum_mismatch"),
    ("purchase", "revenue", "revenue_spike"),
    ("click", "traffic_voice", "voice_traffic_spike"),
    ("view", "qos", "qos_perfect_report"),
    ("signup", "subscribers", None),
)
RUN_1, RUN_2 = "run-1", "run-2"
RUN_2_AT = "2024-02-01 00:00:00"
EXISTING_BEFORE = "2024-01-20 00:00:00"
INCOMING_FROM = "2024-01-10 00:00:00"
# Thresholds already configured before the defaults are ensured.
CONFIGURED_THRESHOLDS = (
    ("revenue", "warning", 500, True),
    ("qos", "warning", 100000, True),
    ("traffic_voice", "warning", 1, False),
)


def _map(col: str, idx: int) -> F.Column:
    expr = None
    for row in TYPE_MAP:
        v = F.lit(row[idx]).cast("string")
        expr = F.when(F.col(col) == row[0], v) if expr is None else expr.when(F.col(col) == row[0], v)
    return expr


def anomaly_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = event_facts(spark, sf_dir)
    return ev.select(
        _map("event_type", 1).alias("domain"),
        "operator_id",
        "service_segment",
        "report_period",
        F.lit(None).cast("string").alias("region_code"),
        F.lit("events").alias("source_table"),
        F.concat(F.lit("evt-"), F.col("event_id").cast("string")).alias("source_id"),
        F.col("event_id").cast("string").alias("bronze_id"),
        _map("event_type", 2).alias("anomaly_code"),
        F.lit(None).cast("string").alias("changed_fields"),
        F.col("value").cast("decimal(22,6)").alias("observed_value"),
        F.col("props").alias("raw_payload"),
        "ts",
        "status",
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised events with the driver status mapping (an existing registry)."""
    return events.normalize(anomaly_rows(spark, sf_dir), keep=("ts", "status", "raw_payload"))


_TYPE_CASE = "CASE event_type " + " ".join(
    f"WHEN '{t}' THEN {('NULL' if v is None else repr(v))}" for t, _, v in TYPE_MAP
) + " END"
_DOMAIN_CASE = "CASE event_type " + " ".join(f"WHEN '{t}' THEN '{d}'" for t, d, _ in TYPE_MAP) + " END"

_EVENT_SQL = """
  SELECT e.event_id, e.ts, e.event_type, e.value, e.props,
         strftime(e.ts, '%Y-%m') AS report_period, n.n_name AS operator_id, c.c_mktsegment AS service_segment,
         (['open', 'acknowledged', 'resolved', 'false_positive'])[(e.event_id % 4) + 1] AS status
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""
_REGISTRY_SQL = f"""
  SELECT md5(domain || ':' || CAST(event_id AS VARCHAR) || ':' || COALESCE(code, 'unknown')) AS event_fingerprint,
         domain,
         CASE WHEN code IN ('active_exceeds_total', 'component_sum_mismatch', 'usf_rate_high') THEN 'critical'
              ELSE 'warning' END AS severity,
         COALESCE(code, 'synthetic_anomaly') AS event_code,
         CASE WHEN code = 'arpu_spike' THEN 'arpu_xaf'
              WHEN code = 'complaint_spike' THEN 'qos_related_complaints'
              WHEN code = 'qos_perfect_report' THEN 'network_availability_pct'
              WHEN code IN ('voice_traffic_spike', 'sms_traffic_spike', 'internet_traffic_spike') THEN 'traffic_volume'
         END AS metric_name,
         operator_id, service_segment, report_period,
         CAST(value AS DECIMAL(22,6)) AS observed_value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS marker_k,
         code AS metadata_code, '[]' AS metadata_changed_fields,
         event_id, ts, status
  FROM (SELECT *, {_DOMAIN_CASE} AS domain, {_TYPE_CASE} AS code FROM ({_EVENT_SQL}) x) y
"""


@query(
    "event_registry",
    f"""
SELECT event_fingerprint, domain, severity, event_code, metric_name, operator_id, service_segment, report_period,
       observed_value, marker_k, metadata_code, metadata_changed_fields
FROM ({_REGISTRY_SQL}) r
""",
)
def event_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint, severity, metric, default code, JSON field and metadata."""
    return registry(spark, sf_dir).select(
        "event_fingerprint",
        "domain",
        "severity",
        "event_code",
        "metric_name",
        "operator_id",
        "service_segment",
        "report_period",
        "observed_value",
        F.get_json_object("raw_payload", "$.k").cast("int").alias("marker_k"),
        F.get_json_object("metadata", "$.anomaly_code").alias("metadata_code"),
        F.get_json_object("metadata", "$.changed_fields").alias("metadata_changed_fields"),
    )


@query(
    "event_lifecycle",
    f"""
WITH r AS ({_REGISTRY_SQL}),
ex AS (
  SELECT event_fingerprint, domain, event_code, status, ts AS detected_at,
         CASE WHEN status = 'resolved' THEN ts END AS resolved_at, '{RUN_1}' AS detected_by_run_id
  FROM r WHERE ts < TIMESTAMP '{EXISTING_BEFORE}'
),
inc AS (SELECT event_fingerprint, domain, event_code FROM r WHERE ts >= TIMESTAMP '{INCOMING_FROM}')
SELECT COALESCE(i.event_fingerprint, e.event_fingerprint) AS event_fingerprint,
       COALESCE(i.domain, e.domain) AS domain,
       COALESCE(i.event_code, e.event_code) AS event_code,
       CASE WHEN i.event_fingerprint IS NULL THEN e.status
            WHEN e.status IS NULL OR e.status = 'resolved' THEN 'open'
            ELSE e.status END AS status,
       CASE WHEN i.event_fingerprint IS NOT NULL THEN TIMESTAMP '{RUN_2_AT}' ELSE e.detected_at END AS detected_at,
       e.resolved_at,
       CASE WHEN i.event_fingerprint IS NOT NULL THEN '{RUN_2}' ELSE e.detected_by_run_id END AS detected_by_run_id
FROM ex e FULL OUTER JOIN inc i ON e.event_fingerprint = i.event_fingerprint
""",
)
def event_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing registry (events before the 20th) upserted with a second run's
    batch (events from the 10th): matched resolved events reopen, others keep status."""
    r = registry(spark, sf_dir)
    ex = r.filter(F.col("ts") < F.lit(EXISTING_BEFORE).cast("timestamp_ntz"))
    existing = ex.select(
        stable_id(F.lit("event"), "event_fingerprint").alias("event_id"),
        *[c for c in r.columns if c not in ("ts", "status", "raw_payload")],
        "status",
        F.col("ts").cast("timestamp").alias("detected_at"),
        F.when(F.col("status") == "resolved", F.col("ts")).cast("timestamp").alias("resolved_at"),
        F.lit(RUN_1).alias("detected_by_run_id"),
        F.lit(None).cast("string").alias("resolution_note"),
    )
    incoming = r.filter(F.col("ts") >= F.lit(INCOMING_FROM).cast("timestamp_ntz")).drop("ts", "status", "raw_payload")
    out = events.upsert_events(existing, incoming, RUN_2, RUN_2_AT)
    return out.select(
        "event_fingerprint",
        "domain",
        "event_code",
        "status",
        F.col("detected_at").cast("timestamp_ntz").alias("detected_at"),
        F.col("resolved_at").cast("timestamp_ntz").alias("resolved_at"),
        "detected_by_run_id",
    )


_LIFECYCLE_SQL = ORACLES["event_lifecycle"]


@query("event_lifecycle_stream", _LIFECYCLE_SQL)
def event_lifecycle_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two runs of ``event_lifecycle`` as a stream of actions through keyed state, four batches."""
    r = registry(spark, sf_dir)
    second = F.unix_micros(F.lit(RUN_2_AT).cast("timestamp"))
    old = r.filter(F.col("ts") < F.lit(EXISTING_BEFORE).cast("timestamp_ntz")).withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    new = r.filter(F.col("ts") >= F.lit(INCOMING_FROM).cast("timestamp_ntz")).withColumn("at", second)

    def actions(rows: DataFrame, action: str, run: str | None) -> DataFrame:
        return rows.select(
            "event_fingerprint", "at", F.lit(int(action == "review")).cast("long").alias("seq"), F.lit(action).alias("action"),
            (F.col("status") if action == "review" else F.lit(None).cast("string")).alias("status"),
            "domain", "event_code", "severity", "report_period", F.lit(run).cast("string").alias("run_id"))

    ensure_checkpoint_dir(spark)
    root = shared_scratch(spark, f"lifecycle-{uuid.uuid4().hex[:12]}")
    half = F.pmod(F.xxhash64("event_fingerprint"), F.lit(2))
    batches = [actions(old, "seen", RUN_1), actions(old.where("status <> 'open'"), "review", None)]
    batches += [actions(new.where(half == k), "seen", RUN_2) for k in (0, 1)]
    for k, rows in enumerate(batches):  # a folder a run, as a run would leave it
        rows.write.option("compression", "zstd").parquet(f"{root}/actions/run{k}")
        out = stateful.run_registry(spark, f"{root}/actions", root)
    time = lambda c: F.timestamp_micros(c).cast("timestamp_ntz").alias(c)
    return out.select("event_fingerprint", "domain", "event_code", "status", time("detected_at"), time("resolved_at"), F.col("run_id").alias("detected_by_run_id"))


def threshold_table(spark: SparkSession) -> DataFrame:
    configured = alerts.thresholds_df(spark, CONFIGURED_THRESHOLDS)
    return alerts.ensure_thresholds(configured, alerts.thresholds_df(spark))


def alert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = registry(spark, sf_dir).withColumn("event_id", F.col("bronze_id"))
    return alerts.evaluate_alerts(threshold_table(spark), r)


_THRESHOLDS_SQL = (
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{d}', '{s}', {n}, {str(e).upper()})" for d, s, n, e in CONFIGURED_THRESHOLDS)
    + ") t(domain, severity, event_count_threshold, enabled) UNION ALL SELECT * FROM (VALUES "
    + ", ".join(f"('{d}', '{s}', {n}, {str(e).upper()})" for d, s, n, e in alerts.DEFAULT_THRESHOLDS)
    + ") d(domain, severity, event_count_threshold, enabled) WHERE (domain, severity) NOT IN (SELECT (domain, severity) FROM (VALUES "
    + ", ".join(f"('{d}', '{s}')" for d, s, _, _ in CONFIGURED_THRESHOLDS)
    + ") c(domain, severity))"
)
_ALERTS_SQL = f"""
  SELECT '{alerts.ALERT_CODE}' AS alert_code, t.severity, t.domain, e.report_period,
         CAST(COUNT(e.event_id) AS BIGINT) AS event_count, CAST(t.event_count_threshold AS INTEGER) AS threshold_value
  FROM ({_THRESHOLDS_SQL}) t
  LEFT JOIN ({_REGISTRY_SQL}) e
    ON e.domain = t.domain AND e.severity = t.severity AND e.status IN ('open', 'acknowledged')
  WHERE t.enabled
  GROUP BY t.domain, t.severity, t.event_count_threshold, e.report_period
  HAVING COUNT(e.event_id) >= t.event_count_threshold
"""


@query("quality_alerts", _ALERTS_SQL)
def quality_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defaults ensured, enabled thresholds vs open event counts per period."""
    return alert_rows(spark, sf_dir)


@query(
    "alert_routing",
    f"""
WITH a AS ({_ALERTS_SQL}),
d AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY alert_code, domain, report_period
                               ORDER BY event_count DESC, severity DESC, threshold_value DESC) AS rn
  FROM a
)
SELECT d.severity, d.alert_code, d.domain, d.report_period, d.event_count, d.threshold_value,
       r.primary_owner, r.secondary_owner
FROM d LEFT JOIN (VALUES {", ".join(f"('{s}', '{p}', '{q}')" for s, p, q in alerts.ROUTING)}) r(severity, primary_owner, secondary_owner)
  ON d.severity = r.severity
WHERE d.rn = 1
""",
)
def alert_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alert per (code, domain, period), routed to owners by severity."""
    return alerts.route_alerts(alert_rows(spark, sf_dir), alerts.routing_df(spark))


@query(
    "open_events",
    f"""
SELECT report_period, domain, severity, operator_id, service_segment, event_code, COUNT(*) AS open_event_count
FROM ({_REGISTRY_SQL}) r WHERE status IN ('open', 'acknowledged')
GROUP BY report_period, domain, severity, operator_id, service_segment, event_code
""",
)
def open_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open and acknowledged events by six keys."""
    return marts.open_events(registry(spark, sf_dir))


# --- R09 + E01: marked perturbation and marker scan ---------------------------------------

PERTURB_SEED = "202503"
SPIKE = "3"


@query(
    "marked_perturbation",
    f"""
WITH o AS (
  SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
         substr(md5(CAST(o_orderkey AS VARCHAR) || ':{PERTURB_SEED}'), 1, 1) = '0' AS marked
  FROM orders
)
SELECT o_orderkey, marked,
       CAST(CASE WHEN marked THEN o_totalprice * {SPIKE} ELSE o_totalprice END AS DECIMAL(20,2)) AS o_totalprice,
       CASE WHEN marked THEN 'revenue_spike' END AS anomaly_code,
       marked AS has_marker
FROM o
""",
)
def marked_perturbation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash-sampled orders get a revenue spike and a marker object in their
    payload; E01 then finds exactly the marked rows by key presence."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", money("o_totalprice").alias("o_totalprice"))
    marked = F.substring(F.md5(F.concat(F.col("o_orderkey").cast("string"), F.lit(":" + PERTURB_SEED))), 1, 1) == "0"
    new_total = F.when(marked, F.col("o_totalprice") * F.lit(int(SPIKE))).otherwise(F.col("o_totalprice"))
    marker = F.struct(
        F.lit("revenue").alias("domain"),
        F.lit("revenue_spike").alias("code"),
        F.array(F.lit("o_totalprice")).alias("changed_fields"),
    )
    payload = F.when(
        marked,
        F.to_json(F.struct(new_total.cast("decimal(20,2)").alias("o_totalprice"), marker.alias(events.MARKER_KEY))),
    ).otherwise(F.to_json(F.struct(F.col("o_totalprice").alias("o_totalprice"))))
    p = o.select("o_orderkey", marked.alias("marked"), new_total.cast("decimal(20,2)").alias("o_totalprice"), payload.alias("_raw_payload"))
    return p.select(
        "o_orderkey",
        "marked",
        "o_totalprice",
        F.get_json_object("_raw_payload", f"$.{events.MARKER_KEY}.code").alias("anomaly_code"),
        has_key("_raw_payload", events.MARKER_KEY).alias("has_marker"),
    )


@query(
    "event_breakdown",
    f"""
SELECT domain, event_code, severity, COUNT(*) AS events
FROM ({_REGISTRY_SQL}) r GROUP BY domain, event_code, severity
""",
)
def event_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by (domain, code, severity)."""
    return registry(spark, sf_dir).groupBy("domain", "event_code", "severity").agg(F.count(F.lit(1)).alias("events"))

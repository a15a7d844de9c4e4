"""Data-quality events: marker scan, normalisation, fingerprint, lifecycle upsert.

An event is a suspicious-but-valid silver row: its bronze payload carries a
marker object. Events are keyed by an MD5 fingerprint of (domain, bronze id,
code) so a rerun refreshes instead of duplicating, and a resolved event that
is seen again is reopened.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import fingerprint, stable_id
from ..functions.json import has_key, json_text
from .upsert import latest_per_key
from .validate import incremental

# Fixed values of the event registry.
MARKER_KEY = "_synthetic_anomaly"
CRITICAL_CODES = ("active_exceeds_total", "component_sum_mismatch", "usf_rate_high")
METRIC_NAMES = (
    ("arpu_spike", "arpu_xaf"),
    ("complaint_spike", "qos_related_complaints"),
    ("qos_perfect_report", "network_availability_pct"),
    ("voice_traffic_spike", "traffic_volume"),
    ("sms_traffic_spike", "traffic_volume"),
    ("internet_traffic_spike", "traffic_volume"),
)
DEFAULT_EVENT_CODE = "synthetic_anomaly"
EVENT_MESSAGE = "Synthetic anomaly marker detected and retained in silver for monitoring."
DETECTION_RULE = "synthetic_anomaly_marker"
METADATA_SOURCE = "synthetic_injection"
STATUSES = ("open", "acknowledged", "resolved", "false_positive")
SEVERITIES = ("info", "warning", "error", "critical")

ANOMALY_COLUMNS = (
    "domain",
    "operator_id",
    "service_segment",
    "report_period",
    "region_code",
    "source_table",
    "source_id",
    "bronze_id",
    "anomaly_code",
    "changed_fields",
    "observed_value",
    "raw_payload",
)


def marker_rows(
    silver: DataFrame,
    bronze: DataFrame,
    domain: str,
    observed: Column,
    source_table: str,
    loaded_after: _dt.datetime | str | None = None,
    marker_key: str = MARKER_KEY,
) -> DataFrame:
    """Silver rows whose bronze payload has the marker key (even if JSON null).

    The bronze side is filtered (marker + load-time bound) and pruned to three
    columns before the equi-join on ``bronze_id``.
    """
    b = incremental(bronze.select("bronze_id", "_raw_payload", "_loaded_at"), loaded_after)
    b = b.filter(has_key("_raw_payload", marker_key))
    j = silver.join(b, "bronze_id", "inner")
    region = F.col("region_code") if "region_code" in silver.columns else F.lit(None).cast("string")
    return j.select(
        F.lit(domain).alias("domain"),
        "operator_id",
        "service_segment",
        "report_period",
        region.alias("region_code"),
        F.lit(source_table).alias("source_table"),
        F.col("silver_id").alias("source_id"),
        "bronze_id",
        json_text("_raw_payload", f"$.{marker_key}.code").alias("anomaly_code"),
        F.get_json_object("_raw_payload", f"$.{marker_key}.changed_fields").alias("changed_fields"),
        observed.cast("decimal(22,6)").alias("observed_value"),
        F.col("_raw_payload").alias("raw_payload"),
    )


def union_anomalies(frames: Sequence[DataFrame]) -> DataFrame:
    """Six homogeneous branches, missing columns padded with typed nulls."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def severity_of(code: str | Column, critical_codes: Sequence[str] = CRITICAL_CODES) -> Column:
    """Critical for the listed codes, warning for everything else."""
    c = F.col(code) if isinstance(code, str) else code
    return F.when(c.isin(*critical_codes), "critical").otherwise("warning")


def metric_name_of(code: str | Column, names: Sequence[tuple[str, str]] = METRIC_NAMES) -> Column:
    """Metric the code speaks about; null for codes without one."""
    c = F.col(code) if isinstance(code, str) else code
    expr = None
    for k, v in names:
        expr = F.when(c == k, v) if expr is None else expr.when(c == k, v)
    return expr.otherwise(F.lit(None).cast("string"))


def metadata_json(code: Column, changed_fields: Column, payload: Column) -> Column:
    """``{source, anomaly_code, changed_fields (default []), raw_payload}`` as JSON.

    Nested JSON is carried as VARIANT so it is embedded, not re-quoted; a null member stays as one.
    """
    return F.to_json(
        F.struct(
            F.lit(METADATA_SOURCE).alias("source"),
            code.alias("anomaly_code"),
            F.coalesce(F.try_parse_json(changed_fields), F.parse_json(F.lit("[]"))).alias("changed_fields"),
            F.try_parse_json(payload).alias("raw_payload"),
        ),
        {"ignoreNullFields": "false"},
    )


def normalize(
    anomalies: DataFrame,
    critical_codes: Sequence[str] = CRITICAL_CODES,
    metric_names: Sequence[tuple[str, str]] = METRIC_NAMES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Fingerprint, severity, default code, message, metric name, metadata.

    ``keep`` passes extra input columns through unchanged.
    """
    code = F.col("anomaly_code")
    return anomalies.select(
        fingerprint("domain", "bronze_id", F.coalesce(code, F.lit("unknown"))).alias("event_fingerprint"),
        "domain",
        severity_of(code, critical_codes).alias("severity"),
        F.coalesce(code, F.lit(DEFAULT_EVENT_CODE)).alias("event_code"),
        F.lit(EVENT_MESSAGE).alias("event_message"),
        F.lit(DETECTION_RULE).alias("detection_rule"),
        "operator_id",
        "service_segment",
        "report_period",
        "region_code",
        "source_table",
        "source_id",
        "bronze_id",
        metric_name_of(code, metric_names).alias("metric_name"),
        "observed_value",
        F.lit(None).cast("decimal(22,6)").alias("expected_min"),
        F.lit(None).cast("decimal(22,6)").alias("expected_max"),
        metadata_json(code, F.col("changed_fields"), F.col("raw_payload")).alias("metadata"),
        *keep,
    )


def upsert_events(
    existing: DataFrame | None,
    incoming: DataFrame,
    run_id: str | None,
    detected_at: str | _dt.datetime | None = None,
) -> DataFrame:
    """Refresh all columns by fingerprint, stamp ``detected_at``; a resolved
    event becomes open again, other statuses are kept; ``resolved_at`` is not cleared.

    Incoming duplicates of one fingerprint are collapsed first (last by bronze id).
    Returns the whole registry after the upsert.
    """
    now = F.current_timestamp() if detected_at is None else F.lit(str(detected_at)).cast("timestamp")
    batch = latest_per_key(incoming, ["event_fingerprint"], ["bronze_id"])
    fresh_cols = [c for c in batch.columns if c != "event_fingerprint"]
    if existing is None:
        return batch.select(
            stable_id(F.lit("event"), "event_fingerprint").alias("event_id"),
            "event_fingerprint",
            *fresh_cols,
            F.lit("open").alias("status"),
            now.alias("detected_at"),
            F.lit(None).cast("timestamp").alias("resolved_at"),
            F.lit(run_id).cast("string").alias("detected_by_run_id"),
            F.lit(None).cast("string").alias("resolution_note"),
        )
    old = existing.select(
        "event_fingerprint",
        *[F.col(c).alias(f"_old_{c}") for c in existing.columns if c != "event_fingerprint"],
    )
    new = batch.select("event_fingerprint", *[F.col(c).alias(f"_new_{c}") for c in fresh_cols], F.lit(True).alias("_seen"))
    j = old.join(new, "event_fingerprint", "full")
    seen = F.coalesce(F.col("_seen"), F.lit(False))
    out = [F.coalesce(F.col("_old_event_id"), stable_id(F.lit("event"), "event_fingerprint")).alias("event_id"), "event_fingerprint"]
    for c in fresh_cols:
        out.append(F.when(seen, F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}")).alias(c))
    old_status = F.col("_old_status")
    out += [
        F.when(~seen, old_status)
        .when(old_status.isNull(), "open")
        .when(old_status == "resolved", "open")
        .otherwise(old_status)
        .alias("status"),
        F.when(seen, now).otherwise(F.col("_old_detected_at")).alias("detected_at"),
        F.col("_old_resolved_at").alias("resolved_at"),
        F.when(seen, F.lit(run_id).cast("string")).otherwise(F.col("_old_detected_by_run_id")).alias("detected_by_run_id"),
        F.col("_old_resolution_note").alias("resolution_note"),
    ]
    return j.select(*out)


def capture_events(
    anomalies: DataFrame,
    existing: DataFrame | None,
    run_id: str | None,
    detected_at: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Normalise the marker rows and upsert them; returns (registry, captured).

    ``captured`` are the rows inserted or updated (its count is the function's
    return value in the original pipeline).
    """
    incoming = normalize(anomalies)
    registry = upsert_events(existing, incoming, run_id, detected_at)
    captured = registry.join(incoming.select("event_fingerprint").distinct(), "event_fingerprint", "left_semi")
    return registry, captured


def resolve(registry: DataFrame, fingerprints: DataFrame, note: str, at: str | None = None) -> DataFrame:
    """Lifecycle step: mark the given fingerprints resolved with a note and time."""
    ts = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    hit = fingerprints.select("event_fingerprint").distinct().withColumn("_hit", F.lit(True))
    j = registry.join(hit, "event_fingerprint", "left")
    h = F.coalesce(F.col("_hit"), F.lit(False))
    return j.withColumns(
        {
            "status": F.when(h, "resolved").otherwise(F.col("status")),
            "resolved_at": F.when(h, ts).otherwise(F.col("resolved_at")),
            "resolution_note": F.when(h, F.lit(note)).otherwise(F.col("resolution_note")),
        }
    ).drop("_hit")

"""Reporting marts (M01-M04, M11) as DataFrame functions.

Shapes follow the silver tables' column names; every function takes the
frames it reads so it can equally run on driver-side analog frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import outer_merge

KPI_KEYS = ("report_period", "operator_id", "service_segment")
OPEN_STATUSES = ("open", "acknowledged")


def subscriber_kpis(subscribers: DataFrame, keys: Sequence[str] = KPI_KEYS) -> DataFrame:
    """Totals and unweighted ARPU average per key."""
    return subscribers.groupBy(*keys).agg(
        F.sum("total_subscribers").alias("total_subscribers"),
        F.sum("active_subscribers_30d").alias("active_subscribers_30d"),
        F.avg("arpu_xaf").alias("avg_arpu_xaf"),
    )


def revenue_kpis(revenue: DataFrame, keys: Sequence[str] = KPI_KEYS) -> DataFrame:
    return revenue.groupBy(*keys).agg(
        F.sum("total_revenue_xaf").alias("total_revenue_xaf"),
        F.sum("usf_contribution_xaf").alias("total_usf_contribution_xaf"),
    )


def qos_kpis(qos: DataFrame, keys: Sequence[str] = KPI_KEYS) -> DataFrame:
    return qos.groupBy(*keys).agg(
        F.avg("network_availability_pct").alias("avg_network_availability_pct"),
        F.avg("avg_latency_ms").alias("avg_latency_ms"),
        F.sum("qos_related_complaints").alias("qos_related_complaints"),
    )


def event_kpis(events: DataFrame, keys: Sequence[str] = KPI_KEYS) -> DataFrame:
    """Filtered counts of open and open-critical events."""
    is_open = F.col("status").isin(*OPEN_STATUSES)
    return events.groupBy(*keys).agg(
        F.count_if(is_open).alias("open_events"),
        F.count_if(is_open & (F.col("severity") == "critical")).alias("open_critical_events"),
    )


def combine_kpis(
    parts: Sequence[tuple[str, DataFrame]],
    zero_default: dict[str, str],
    keys: Sequence[str] = KPI_KEYS,
    form: str = "union",
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """M01 core: merge per-source aggregates on the key (J04) and default measures.

    ``zero_default`` maps measure -> output name for measures that become 0
    when the source has no row; all other measures stay null. ``form`` picks
    the one-shuffle union rewrite or the literal full-outer-join chain.
    """
    merged = outer_merge(parts, keys, form)
    rename = rename or {}
    cols: list[Column] = [F.col(k) for k in keys]
    for c in merged.columns:
        if c in keys:
            continue
        if c in zero_default:
            cols.append(F.coalesce(F.col(c), F.lit(0)).alias(zero_default[c]))
        else:
            cols.append(F.col(c).alias(rename.get(c, c)))
    return merged.select(*cols)


def regulator_kpis(
    subscribers: DataFrame,
    revenue: DataFrame,
    qos: DataFrame,
    events: DataFrame,
    form: str = "union",
) -> DataFrame:
    """Monthly KPIs per (period, operator, segment); measures default to 0
    except the three averages, which stay null without source rows."""
    out = combine_kpis(
        [
            ("subscribers", subscriber_kpis(subscribers)),
            ("revenue", revenue_kpis(revenue)),
            ("qos", qos_kpis(qos)),
            ("events", event_kpis(events)),
        ],
        zero_default={
            "total_subscribers": "total_subscribers",
            "active_subscribers_30d": "active_subscribers_30d",
            "total_revenue_xaf": "total_revenue_xaf",
            "total_usf_contribution_xaf": "total_usf_contribution_xaf",
            "qos_related_complaints": "qos_related_complaints",
            "open_events": "open_quality_events",
            "open_critical_events": "open_critical_quality_events",
        },
        form=form,
    )
    return out.select(
        *KPI_KEYS,
        "total_subscribers",
        "active_subscribers_30d",
        "avg_arpu_xaf",
        "total_revenue_xaf",
        "total_usf_contribution_xaf",
        "avg_network_availability_pct",
        "avg_latency_ms",
        "qos_related_complaints",
        "open_quality_events",
        "open_critical_quality_events",
    )


def share_pct(part: str | Column, total: str | Column, scale: int = 4) -> Column:
    """``round(part / total * 100, scale)`` in exact decimal; 0 when total is 0.

    Both operands go through ``decimal(20,0)`` for integral measures so the
    quotient keeps 18 decimals before the final HALF_UP rounding.
    """
    p = F.col(part) if isinstance(part, str) else part
    t = F.col(total) if isinstance(total, str) else total
    return F.when(t == 0, F.lit(0).cast(f"decimal(10,{scale})")).otherwise(
        F.round(p * F.lit(100) / t, scale).cast(f"decimal(10,{scale})")
    )


def add_shares(
    df: DataFrame,
    group: Sequence[str],
    measures: dict[str, str],
    scale: int = 4,
    cast_to: dict[str, str] | None = None,
) -> DataFrame:
    """Each row's share of its group total, for several measures.

    The totals come from a ``groupBy`` joined back on the group key rather
    than a window: the grouped side is tiny, its partial aggregation is
    skew-proof, and rows with a null group key are dropped exactly like the
    inner join in the scorecard. ``cast_to`` gives each measure a narrow
    decimal type (``decimal(20,0)`` for counts, ``decimal(22,2)`` for money)
    so the quotient keeps at least 12 decimals before the final rounding.
    """
    cast_to = cast_to or {}
    totals = df.groupBy(*group).agg(*[F.sum(m).alias(f"_total_{m}") for m in measures])
    joined = df.join(totals, list(group), "inner")
    outs = []
    for m, out in measures.items():
        part, tot = F.col(m), F.col(f"_total_{m}")
        if m in cast_to:
            part, tot = part.cast(cast_to[m]), tot.cast(cast_to[m])
        outs.append(share_pct(part, tot, scale).alias(out))
    return joined.select(*df.columns, *outs)


def operator_scorecard(kpis: DataFrame) -> DataFrame:
    """KPI columns plus subscriber and revenue market share per (period, segment)."""
    base = kpis.select(
        *KPI_KEYS,
        "total_subscribers",
        "active_subscribers_30d",
        "total_revenue_xaf",
        "avg_network_availability_pct",
        "avg_latency_ms",
        "qos_related_complaints",
        "open_quality_events",
        "open_critical_quality_events",
    )
    return add_shares(
        base,
        ["report_period", "service_segment"],
        {"total_subscribers": "subscriber_market_share_pct", "total_revenue_xaf": "revenue_market_share_pct"},
        cast_to={"total_subscribers": "decimal(20,0)", "total_revenue_xaf": "decimal(20,0)"},
    )


def open_events(events: DataFrame) -> DataFrame:
    """open/acknowledged events counted by six keys."""
    keys = ["report_period", "domain", "severity", "operator_id", "service_segment", "event_code"]
    return (
        events.filter(F.col("status").isin(*OPEN_STATUSES))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("open_event_count"))
    )


def open_events_ranked(events: DataFrame) -> DataFrame:
    """Open events by (period, operator, domain, severity), most first."""
    return (
        events.filter(F.col("status").isin(*OPEN_STATUSES))
        .groupBy("report_period", "operator_id", "domain", "severity")
        .agg(F.count(F.lit(1)).alias("open_events"))
        .orderBy(F.desc("open_events"), "report_period", "operator_id", "domain", "severity")
    )


def run_health_label(rejected: str | Column, alerts: str | Column, events: str | Column) -> Column:
    """Attention if rejections or alerts, watch if events, else healthy."""
    r = F.col(rejected) if isinstance(rejected, str) else rejected
    a = F.col(alerts) if isinstance(alerts, str) else alerts
    e = F.col(events) if isinstance(events, str) else events
    return F.when((r > 0) | (a > 0), "attention").when(e > 0, "watch").otherwise("healthy")


def run_health(metrics: DataFrame) -> DataFrame:
    """M04 view: metrics rows with the health label."""
    return metrics.select(
        "report_period",
        "validation_started_at",
        "validation_window_start",
        "rows_ingested",
        "rows_processed",
        "rows_validated",
        "rows_rejected",
        "events_captured",
        "alerts_triggered",
        run_health_label("rows_rejected", "alerts_triggered", "events_captured").alias("run_health"),
    )


def dashboard_slice(
    df: DataFrame,
    group: Sequence[str],
    measures: dict[str, Column],
    filters: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Filter by period/operator/segment/domain lists, then aggregate."""
    out = df
    for c, values in (filters or {}).items():
        out = out.filter(F.col(c).isin(list(values)))
    return out.groupBy(*group).agg(*[v.alias(k) for k, v in measures.items()])

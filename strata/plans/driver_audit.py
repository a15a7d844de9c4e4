"""Audit, run health, data tests and inventory on the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import period_of
from ..operators import audit, dq, marts, series
from ..operators.joins import outer_merge
from ..operators.validate import CODES, incremental
from . import driver_queries as dqs
from .driver_events import _ALERTS_SQL, _REGISTRY_SQL, alert_rows, registry
from .driver_rules import MARKET_SEGMENTS, _VALIDATED_ORDERS_SQL, validated_orders
from .registry import query
from .tables import order_facts, table

VALIDATION_STARTED_AT = "2024-02-05 14:23:11"
DOMAIN_ORDER = ("orders", "lineitem", "events")


def loaded_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three driver facts as (report_period, _loaded_at) — load time = fact date."""
    return {
        "orders": table(spark, sf_dir, "orders").select(
            period_of("o_orderdate").alias("report_period"), F.col("o_orderdate").alias("_loaded_at")
        ),
        "lineitem": table(spark, sf_dir, "lineitem").select(
            period_of("l_shipdate").alias("report_period"), F.col("l_shipdate").alias("_loaded_at")
        ),
        "events": table(spark, sf_dir, "events").select(period_of("ts").alias("report_period"), F.col("ts").alias("_loaded_at")),
    }


_LOADED_SQL = """
  SELECT 'orders' AS domain, 0 AS domain_order, strftime(o_orderdate, '%Y-%m') AS report_period, o_orderdate AS ts FROM orders
  UNION ALL SELECT 'lineitem', 1, strftime(l_shipdate, '%Y-%m'), l_shipdate FROM lineitem
  UNION ALL SELECT 'events', 2, strftime(ts, '%Y-%m'), ts FROM events
"""


# --- M04 / A10: run health -------------------------------------------------------------


@query(
    "run_health",
    f"""
WITH v AS ({_VALIDATED_ORDERS_SQL}),
vo AS (
  SELECT v.report_period, MIN(o.o_orderdate) AS validation_window_start, COUNT(*) AS rows_processed,
         COUNT(*) FILTER (WHERE len(v.codes) = 0) AS rows_validated, COUNT(*) FILTER (WHERE len(v.codes) > 0) AS rows_rejected
  FROM v JOIN orders o ON v.o_orderkey = o.o_orderkey GROUP BY v.report_period
),
ev AS (SELECT report_period, COUNT(*) AS events_captured FROM ({_REGISTRY_SQL}) r GROUP BY report_period),
al AS (SELECT report_period, COUNT(*) AS alerts_triggered FROM ({_ALERTS_SQL}) a GROUP BY report_period),
m AS (
  SELECT COALESCE(vo.report_period, ev.report_period, al.report_period) AS report_period,
         vo.validation_window_start,
         CAST(COALESCE(vo.rows_processed, 0) AS BIGINT) AS rows_ingested,
         CAST(COALESCE(vo.rows_processed, 0) AS BIGINT) AS rows_processed,
         CAST(COALESCE(vo.rows_validated, 0) AS BIGINT) AS rows_validated,
         CAST(COALESCE(vo.rows_rejected, 0) AS BIGINT) AS rows_rejected,
         CAST(COALESCE(ev.events_captured, 0) AS BIGINT) AS events_captured,
         CAST(COALESCE(al.alerts_triggered, 0) AS BIGINT) AS alerts_triggered
  FROM vo FULL OUTER JOIN ev ON vo.report_period = ev.report_period
  FULL OUTER JOIN al ON COALESCE(vo.report_period, ev.report_period) = al.report_period
)
SELECT report_period, TIMESTAMP '{VALIDATION_STARTED_AT}' AS validation_started_at, validation_window_start,
       rows_ingested, rows_processed, rows_validated, rows_rejected, events_captured, alerts_triggered,
       CASE WHEN rows_rejected > 0 OR alerts_triggered > 0 THEN 'attention'
            WHEN events_captured > 0 THEN 'watch' ELSE 'healthy' END AS run_health
FROM m
""",
)
def run_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M04 over per-period metrics: validation counts, events captured, alerts raised."""
    v = validated_orders(spark, sf_dir)
    valid = F.size(CODES) == 0
    vo = v.groupBy("report_period").agg(
        F.min("o_orderdate").alias("validation_window_start"),
        F.count(F.lit(1)).alias("rows_processed"),
        F.count_if(valid).alias("rows_validated"),
        F.count_if(~valid).alias("rows_rejected"),
    )
    ev = registry(spark, sf_dir).groupBy("report_period").agg(F.count(F.lit(1)).alias("events_captured"))
    al = alert_rows(spark, sf_dir).groupBy("report_period").agg(F.count(F.lit(1)).alias("alerts_triggered"))
    m = outer_merge([("validation", vo), ("events", ev), ("alerts", al)], ["report_period"])
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    metrics = m.select(
        "report_period",
        F.lit(VALIDATION_STARTED_AT).cast("timestamp_ntz").alias("validation_started_at"),
        "validation_window_start",
        z("rows_processed").alias("rows_ingested"),
        z("rows_processed").alias("rows_processed"),
        z("rows_validated").alias("rows_validated"),
        z("rows_rejected").alias("rows_rejected"),
        z("events_captured").alias("events_captured"),
        z("alerts_triggered").alias("alerts_triggered"),
    )
    return marts.run_health(metrics)


# --- M05 / M06 / A06 / T04 / R01: period status and load gate -------------------------------


@query(
    "period_status",
    f"""
WITH p AS ({_LOADED_SQL}),
c AS (SELECT report_period, domain, COUNT(*) AS n FROM p GROUP BY report_period, domain),
b AS (SELECT MIN(report_period) AS lo, MAX(report_period) AS hi FROM c),
s AS (
  SELECT strftime(d, '%Y-%m') AS report_period
  FROM b, generate_series(CAST(lo || '-01' AS DATE), CAST(hi || '-01' AS DATE), INTERVAL 1 MONTH) t(d)
),
dm AS (SELECT * FROM (VALUES ('orders', 0), ('lineitem', 1), ('events', 2)) v(domain, domain_order)),
g AS (
  SELECT s.report_period, dm.domain, dm.domain_order, COALESCE(c.n, 0) AS n
  FROM s CROSS JOIN dm LEFT JOIN c ON c.report_period = s.report_period AND c.domain = dm.domain
),
st AS (
  SELECT report_period, COUNT(*) FILTER (WHERE n > 0) AS loaded_domains,
         list(domain ORDER BY domain_order) FILTER (WHERE n > 0) AS ld
  FROM g GROUP BY report_period
)
SELECT report_period,
       CASE WHEN loaded_domains = 3 THEN 'loaded' WHEN loaded_domains > 0 THEN 'partial' ELSE 'empty' END AS period_status,
       CASE WHEN loaded_domains = 3 THEN 'skip' WHEN loaded_domains > 0 THEN 'error' ELSE 'proceed' END AS action,
       CASE WHEN loaded_domains = 3 THEN '{audit.GATE_LOADED}'
            WHEN loaded_domains > 0 THEN replace(replace('{audit.GATE_PARTIAL.replace("{", "<").replace("}", ">")}', '<period>', report_period),
                                                 '<domains>', '[''' || array_to_string(ld, ''', ''') || ''']')
       END AS reason,
       CAST(loaded_domains AS INTEGER) AS loaded_domains
FROM st
""",
)
def period_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spine of months over the data's range x tables: loaded / partial / empty and
    the backfill decision per period (skip / error / proceed)."""
    frames = {k: f.select("report_period") for k, f in loaded_frames(spark, sf_dir).items()}
    counts = audit.domain_counts(frames)
    spine = series.spine_from(counts)
    grid = audit.period_domain_grid(spine, list(frames))
    full = grid.join(counts, ["report_period", "domain"], "left").select(
        "report_period", "domain", "domain_order", F.coalesce("rows", F.lit(0)).alias("rows")
    )
    status = audit.classify_periods(full, len(frames))
    decision = audit.generation_decision(status)
    return decision.join(status.select("report_period", "loaded_domains"), "report_period")


# --- T01 / T02 / A08: incremental window ----------------------------------------------------

WATERMARK_PERIODS = ("1998-06", "2010-01")


@query(
    "incremental_window",
    f"""
WITH f AS ({_LOADED_SQL}),
w AS (
  SELECT p.report_period, (SELECT MIN(ts) FROM f WHERE f.report_period = p.report_period) AS wm
  FROM (VALUES {", ".join(f"('{p}')" for p in WATERMARK_PERIODS)}) p(report_period)
),
tn AS (SELECT * FROM (VALUES ('orders'), ('lineitem'), ('events')) t(table_name))
SELECT w.report_period, tn.table_name, w.wm AS validation_window_start,
       (SELECT COUNT(*) FROM f WHERE f.domain = tn.table_name AND (w.wm IS NULL OR f.ts >= w.wm)) AS rows_processed
FROM w, tn
""",
)
def incremental_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T02 watermark = earliest load time of the period over all tables (a scalar
    resolved before planning); T01 then keeps rows at or after it, or all rows
    when the period has none (full revalidation)."""
    frames = loaded_frames(spark, sf_dir)
    out = []
    for p in WATERMARK_PERIODS:
        wm = audit.validation_window_start(list(frames.values()), p).first()[0]
        for name, f in frames.items():
            n = incremental(f, wm).agg(F.count(F.lit(1)).alias("rows_processed"))
            out.append(
                n.select(
                    F.lit(p).alias("report_period"),
                    F.lit(name).alias("table_name"),
                    F.lit(wm).cast("timestamp_ntz").alias("validation_window_start"),
                    "rows_processed",
                )
            )
    return reduce(lambda a, b: a.unionByName(b), out)


# --- M08 / M09: JSON count maps ---------------------------------------------------------------


@query(
    "json_counts",
    f"""
SELECT report_period, domain, CAST(COUNT(*) AS BIGINT) AS rows, CAST(n_domains AS INTEGER) AS n_domains
FROM (SELECT *, COUNT(DISTINCT domain) OVER (PARTITION BY report_period) AS n_domains FROM ({_LOADED_SQL}) p) x
GROUP BY report_period, domain, n_domains
""",
)
def json_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-period ``{domain: rows}`` JSON maps (M08), exploded back to rows."""
    frames = {k: f.select("report_period") for k, f in loaded_frames(spark, sf_dir).items()}
    counts = audit.domain_counts(frames)
    maps = counts.groupBy("report_period").agg(
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("domain", "rows"))))).alias("rows_by_domain")
    )
    maps = maps.withColumn("n_domains", F.size(F.json_object_keys("rows_by_domain")))
    return audit.explode_count_map(maps, "rows_by_domain").select("report_period", "domain", "rows", "n_domains")


# --- O02: latest runs ----------------------------------------------------------------------


@query(
    "latest_runs",
    """
SELECT CAST(event_id AS VARCHAR) AS run_id, ts AS started_at, event_type AS status, strftime(ts, '%Y-%m') AS report_period
FROM events ORDER BY ts DESC, event_id DESC LIMIT 12
""",
)
def latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 12 latest runs (events as a run ledger) with a total-order tie-break."""
    runs = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("ts").alias("started_at"),
        F.col("event_type").alias("status"),
        period_of("ts").alias("report_period"),
        "event_id",
    )
    return audit.latest(runs, [F.desc("started_at"), F.desc("event_id")], 12).drop("event_id")


# --- S20 / A14: inventory by grouping sets -------------------------------------------------------


@query(
    "inventory_sets",
    f"""
SELECT service_segment, operator_id, domain, COUNT(*) AS objects
FROM (SELECT service_segment, operator_id, o_orderpriority AS domain FROM ({dqs._ORDER_FACTS_SQL}) f) x
GROUP BY GROUPING SETS ((service_segment), (operator_id), (domain))
""",
)
def inventory_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object counts by segment, by operator and by domain in one grouping-sets pass."""
    f = order_facts(spark, sf_dir).select("service_segment", "operator_id", F.col("o_orderpriority").alias("domain"))
    return f.groupingSets(
        [["service_segment"], ["operator_id"], ["domain"]], "service_segment", "operator_id", "domain"
    ).agg(F.count(F.lit(1)).alias("objects"))


# --- D01-D04: data tests ---------------------------------------------------------------------

_KPI_MEASURES = (
    "total_subscribers",
    "active_subscribers_30d",
    "total_revenue_xaf",
    "total_usf_contribution_xaf",
    "qos_related_complaints",
    "open_quality_events",
    "open_critical_quality_events",
)
_SHARE_SQL = dqs._MARKET_SHARE_SQL


def _test_rows_sql(table_name: str, source: str, tests: list[tuple[str, str, str]]) -> str:
    parts = [
        f"SELECT '{table_name}' AS table_name, '{t}' AS test, '{c}' AS column_name, "
        f"CAST(COUNT(*) FILTER (WHERE {pred}) AS BIGINT) AS failures FROM ({source}) s"
        for t, c, pred in tests
    ]
    return " UNION ALL ".join(parts)


_SEGS = ", ".join(f"'{s}'" for s in MARKET_SEGMENTS)


@query(
    "data_tests",
    "SELECT table_name, test, column_name, failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ("
    + _test_rows_sql(
        "regulator_kpis",
        dqs._KPI_SQL,
        [
            ("not_null", "report_period", "report_period IS NULL"),
            ("not_null", "operator_id", "operator_id IS NULL"),
            ("not_null", "service_segment", "service_segment IS NULL"),
            ("not_null", "total_revenue_xaf", "total_revenue_xaf IS NULL"),
            ("accepted_values", "service_segment", f"service_segment IS NOT NULL AND service_segment NOT IN ({_SEGS})"),
            ("kpis_nonnegative", "", " OR ".join(f"{m} < 0" for m in _KPI_MEASURES)),
        ],
    )
    + " UNION ALL "
    + _test_rows_sql(
        "market_share",
        _SHARE_SQL,
        [
            ("not_null", "order_share_pct", "order_share_pct IS NULL"),
            ("not_null", "revenue_share_pct", "revenue_share_pct IS NULL"),
            (
                "share_bounds",
                "",
                "order_share_pct < 0 OR order_share_pct > 100 OR revenue_share_pct < 0 OR revenue_share_pct > 100",
            ),
        ],
    )
    + ") t",
)
def data_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D01 not_null, D02 accepted_values, D03 share bounds, D04 non-negative KPIs;
    each table's tests in one aggregate pass."""
    k = dqs.kpis_union_form(spark, sf_dir)
    t1 = dq.data_tests(
        k,
        "regulator_kpis",
        not_null=["report_period", "operator_id", "service_segment", "total_revenue_xaf"],
        accepted={"service_segment": MARKET_SEGMENTS},
        failing={"kpis_nonnegative": reduce(lambda a, b: a | b, [F.col(m) < 0 for m in _KPI_MEASURES])},
    )
    m = dqs.market_share(spark, sf_dir)
    share_bad = reduce(
        lambda a, b: a | b,
        [(F.col(c) < 0) | (F.col(c) > 100) for c in ("order_share_pct", "revenue_share_pct")],
    )
    t2 = dq.data_tests(m, "market_share", not_null=["order_share_pct", "revenue_share_pct"], failing={"share_bounds": share_bad})
    return t1.unionByName(t2)


# --- D05: freshness -------------------------------------------------------------------------

FRESHNESS_AS_OF = "2024-03-20 00:00:00"


@query(
    "freshness",
    f"""
SELECT source, max_loaded_at,
       CAST(date_sub('second', max_loaded_at, TIMESTAMP '{FRESHNESS_AS_OF}') AS BIGINT) AS age_seconds,
       CASE WHEN max_loaded_at IS NULL THEN 'error'
            WHEN date_sub('second', max_loaded_at, TIMESTAMP '{FRESHNESS_AS_OF}') > {dq.ERROR_AFTER_DAYS} * 86400 THEN 'error'
            WHEN date_sub('second', max_loaded_at, TIMESTAMP '{FRESHNESS_AS_OF}') > {dq.WARN_AFTER_DAYS} * 86400 THEN 'warn'
            ELSE 'pass' END AS status
FROM (SELECT domain AS source, MAX(ts) AS max_loaded_at FROM ({_LOADED_SQL}) p GROUP BY domain) m
""",
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest load time per source vs a fixed as-of: pass / warn (45 d) / error (75 d)."""
    frames = loaded_frames(spark, sf_dir)
    return dq.freshness({k: (f, "_loaded_at") for k, f in frames.items()}, FRESHNESS_AS_OF)

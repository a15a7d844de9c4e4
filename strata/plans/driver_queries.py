"""Library operators run on the driver tables by analogy (see ``tables``).

Each query is registered with an equivalent DuckDB statement. Output
columns and types are pinned on both sides: counts ``bigint``, money
``decimal(38,2)``, shares ``decimal(10,4)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import marts
from .registry import avg_sql, pct_sql, query
from .tables import event_facts, order_facts, period_facts

KEYS = list(marts.KPI_KEYS)

_ORDER_FACTS_SQL = """
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, CAST(o.o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
         o.o_orderdate, o.o_orderpriority, strftime(o.o_orderdate, '%Y-%m') AS report_period,
         n.n_name AS operator_id, r.r_name AS region_code, c.c_mktsegment AS service_segment
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""


# --- M02 / A03 / J05: market share -------------------------------------------


def order_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = order_facts(spark, sf_dir)
    return f.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("o_totalprice").cast("decimal(38,2)").alias("total_revenue"),
    )


_MARKET_SHARE_SQL = f"""
WITH f AS ({_ORDER_FACTS_SQL}),
k AS (
  SELECT report_period, operator_id, service_segment, COUNT(*) AS total_orders,
         CAST(SUM(o_totalprice) AS DECIMAL(38,2)) AS total_revenue
  FROM f GROUP BY report_period, operator_id, service_segment
),
t AS (
  SELECT report_period, service_segment, SUM(total_orders) AS t_orders, SUM(total_revenue) AS t_revenue
  FROM k GROUP BY report_period, service_segment
)
SELECT k.report_period, k.operator_id, k.service_segment, k.total_orders, k.total_revenue,
       {pct_sql('k.total_orders', 't.t_orders')} AS order_share_pct,
       {pct_sql('k.total_revenue', 't.t_revenue', unit=100)} AS revenue_share_pct
FROM k JOIN t ON k.report_period = t.report_period AND k.service_segment = t.service_segment
"""


@query("market_share", _MARKET_SHARE_SQL)
def market_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each operator in its (period, segment): orders and revenue."""
    return marts.add_shares(
        order_kpis(spark, sf_dir),
        ["report_period", "service_segment"],
        {"total_orders": "order_share_pct", "total_revenue": "revenue_share_pct"},
        cast_to={"total_orders": "decimal(20,0)", "total_revenue": "decimal(22,2)"},
    )


# --- M01 / A01 / A02 / J04: regulator KPIs ----------------------------------------

_CUST_SQL = """
  SELECT c.c_custkey, n.n_name AS operator_id, c.c_mktsegment AS service_segment
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

_EVENT_FACTS_SQL = f"""
  SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value, e.props,
         strftime(e.ts, '%Y-%m') AS report_period, c.operator_id, c.service_segment,
         CASE WHEN e.event_type = 'error' THEN 'critical' ELSE 'warning' END AS severity,
         (['open', 'acknowledged', 'resolved', 'false_positive'])[(e.event_id % 4) + 1] AS status
  FROM events e LEFT JOIN ({_CUST_SQL}) c ON e.user_id = c.c_custkey
"""


def kpi_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Silver-shaped analogs: subscribers = orders, revenue = line items by ship
    month, QoS and quality events = events (user -> customer)."""
    o = order_facts(spark, sf_dir)
    subs = o.select(
        *KEYS,
        F.lit(1).alias("total_subscribers"),
        F.when(F.col("o_orderstatus") == "O", 1).otherwise(0).alias("active_subscribers_30d"),
        F.col("o_totalprice").alias("arpu_xaf"),
    )
    li = period_facts(spark, sf_dir)
    rev = li.select(
        *KEYS,
        F.col("l_extendedprice").alias("total_revenue_xaf"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("usf_contribution_xaf"),
    )
    ev = event_facts(spark, sf_dir)
    qos = ev.select(
        *KEYS,
        F.col("value").cast("decimal(10,2)").alias("network_availability_pct"),
        F.col("user_id").cast("int").alias("avg_latency_ms"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("qos_related_complaints"),
    )
    events = ev.select(*KEYS, "severity", "status")
    return subs, rev, qos, events


def _kpis(spark: SparkSession, sf_dir: str, form: str) -> DataFrame:
    k = marts.regulator_kpis(*kpi_sources(spark, sf_dir), form=form)
    return k.select(
        *KEYS,
        F.col("total_subscribers").cast("bigint").alias("total_subscribers"),
        F.col("active_subscribers_30d").cast("bigint").alias("active_subscribers_30d"),
        F.col("avg_arpu_xaf").cast("decimal(22,6)").alias("avg_arpu_xaf"),
        F.col("total_revenue_xaf").cast("decimal(38,2)").alias("total_revenue_xaf"),
        F.col("total_usf_contribution_xaf").cast("decimal(38,4)").alias("total_usf_contribution_xaf"),
        F.col("avg_network_availability_pct").cast("decimal(14,6)").alias("avg_network_availability_pct"),
        F.col("avg_latency_ms").cast("double").alias("avg_latency_ms"),
        F.col("qos_related_complaints").cast("bigint").alias("qos_related_complaints"),
        F.col("open_quality_events").cast("bigint").alias("open_quality_events"),
        F.col("open_critical_quality_events").cast("bigint").alias("open_critical_quality_events"),
    )


# Written from the definition: all facts in one stack, one GROUP BY. A key with a
# null never meets another source's, so such rows keep their source apart.
_KPI_SQL = f"""
WITH c AS ({_CUST_SQL}),
ef AS ({_EVENT_FACTS_SQL}),
stack AS (
  SELECT 'order' AS src, strftime(o.o_orderdate, '%Y-%m') AS report_period, c.operator_id, c.service_segment,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS price, o.o_orderstatus = 'O' AS active
  FROM orders o JOIN c ON o.o_custkey = c.c_custkey
  UNION ALL BY NAME
  SELECT 'line' AS src, strftime(l.l_shipdate, '%Y-%m') AS report_period, c.operator_id, c.service_segment,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS revenue,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(18,2)) AS usf
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN c ON o.o_custkey = c.c_custkey
  UNION ALL BY NAME
  SELECT 'quality of service' AS src, report_period, operator_id, service_segment,
         CAST(value AS DECIMAL(10,2)) AS availability, CAST(user_id AS INTEGER) AS latency, event_type = 'error' AS complaint
  FROM ef
  UNION ALL BY NAME
  SELECT 'quality event' AS src, report_period, operator_id, service_segment,
         status IN ('open', 'acknowledged') AS is_open, severity = 'critical' AS is_critical
  FROM ef
)
SELECT report_period, operator_id, service_segment,
       COUNT(*) FILTER (WHERE src = 'order') AS total_subscribers,
       COUNT(*) FILTER (WHERE active) AS active_subscribers_30d,
       {avg_sql('price', 2, 6, 'DECIMAL(22,6)')} AS avg_arpu_xaf,
       CAST(COALESCE(SUM(revenue), 0) AS DECIMAL(38,2)) AS total_revenue_xaf,
       CAST(COALESCE(SUM(usf), 0) AS DECIMAL(38,4)) AS total_usf_contribution_xaf,
       {avg_sql('availability', 2, 6, 'DECIMAL(14,6)')} AS avg_network_availability_pct,
       CAST(AVG(latency) AS DOUBLE) AS avg_latency_ms,
       COUNT(*) FILTER (WHERE complaint) AS qos_related_complaints,
       COUNT(*) FILTER (WHERE is_open) AS open_quality_events,
       COUNT(*) FILTER (WHERE is_open AND is_critical) AS open_critical_quality_events
FROM stack
GROUP BY report_period, operator_id, service_segment,
         CASE WHEN report_period IS NULL OR operator_id IS NULL OR service_segment IS NULL THEN src END
"""


@query("regulator_kpis", _KPI_SQL)
def regulator_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M01 in its literal form: chain of FULL OUTER joins on coalesced keys."""
    return _kpis(spark, sf_dir, "join")


@query("kpis_union_form", _KPI_SQL)
def kpis_union_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M01 rewritten as one union + groupBy (one shuffle instead of one per join)."""
    return _kpis(spark, sf_dir, "union")


# --- M11: dashboard slice ----------------------------------------------------------

DASHBOARD_SEGMENTS = ("AUTOMOBILE", "MACHINERY")


@query(
    "dashboard_trends",
    f"""
WITH k AS ({_KPI_SQL})
SELECT report_period, service_segment,
       CAST(SUM(total_revenue_xaf) AS DECIMAL(38,2)) AS revenue,
       CAST(SUM(total_subscribers) AS BIGINT) AS subscribers,
       CAST(SUM(open_quality_events) AS BIGINT) AS open_events,
       CAST(COUNT(*) AS BIGINT) AS operators
FROM k WHERE service_segment IN ({", ".join(repr(s) for s in DASHBOARD_SEGMENTS)})
GROUP BY report_period, service_segment
""",
)
def dashboard_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue / subscriber / event trends for a segment filter over the KPI mart."""
    k = _kpis(spark, sf_dir, "union")
    return marts.dashboard_slice(
        k,
        ["report_period", "service_segment"],
        {
            "revenue": F.sum("total_revenue_xaf").cast("decimal(38,2)"),
            "subscribers": F.sum("total_subscribers").cast("bigint"),
            "open_events": F.sum("open_quality_events").cast("bigint"),
            "operators": F.count(F.lit(1)).cast("bigint"),
        },
        {"service_segment": DASHBOARD_SEGMENTS},
    )

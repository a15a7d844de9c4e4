"""Runbook reports on the driver tables: rejections by operator, ranked open events, run ledger,
landing inventory, dashboard slices, period progress (A07, A10-A12, M07, M11, R11, S13, S14, S20)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import period_of, period_progress
from ..operators import audit, marts
from ..operators.validate import CODES, validate
from ..sources import landing
from . import telecom_bronze as tb
from .driver_events import _REGISTRY_SQL, registry
from .driver_queries import _CUST_SQL, _KPI_SQL, _kpis
from .driver_rules import _LINE_CASES, _LINES_SQL, _VALIDATED_ORDERS_SQL, _sql_codes, lineitem_rules, lineitems, validated_orders, validation_counts
from .registry import ORACLES, query
from .tables import order_facts, period_facts, table

# --- rejections ---------------------------------------------------------------------------


def judged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(report_period, operator_id, domain, rejected) of every order and line item."""
    keys = order_facts(spark, sf_dir).select("o_orderkey", "report_period", "operator_id")
    orders = validated_orders(spark, sf_dir).select("o_orderkey", (F.size(CODES) > 0).alias("rejected")).join(keys, "o_orderkey")
    line_keys = period_facts(spark, sf_dir).select("l_orderkey", "l_linenumber", "report_period", "operator_id")
    lines = validate(lineitems(spark, sf_dir), lineitem_rules()).select("l_orderkey", "l_linenumber", (F.size(CODES) > 0).alias("rejected"))
    lines = lines.join(line_keys, ["l_orderkey", "l_linenumber"])
    cols = ["report_period", "operator_id", "domain", "rejected"]
    return orders.withColumn("domain", F.lit("orders")).select(*cols).unionByName(lines.withColumn("domain", F.lit("lineitem")).select(*cols))


_JUDGED_SQL = f"""
  SELECT strftime(o.o_orderdate, '%Y-%m') AS report_period, c.operator_id, 'orders' AS domain, len(v.codes) > 0 AS rejected
  FROM ({_VALIDATED_ORDERS_SQL}) v JOIN orders o ON v.o_orderkey = o.o_orderkey JOIN ({_CUST_SQL}) c ON o.o_custkey = c.c_custkey
  UNION ALL
  SELECT strftime(l.l_shipdate, '%Y-%m'), c.operator_id, 'lineitem', len(v.codes) > 0
  FROM (SELECT *, {_sql_codes(_LINE_CASES)} AS codes FROM ({_LINES_SQL}) x) v
  JOIN lineitem l ON v.l_orderkey = l.l_orderkey AND v.l_linenumber = l.l_linenumber
  JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN ({_CUST_SQL}) c ON o.o_custkey = c.c_custkey
"""


@query(
    "rejections_by_operator",
    f"SELECT report_period, operator_id, domain, COUNT(*) AS rejected_rows FROM ({_JUDGED_SQL}) WHERE rejected GROUP BY ALL",
)
def rejections_by_operator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows by (period, operator, domain) over the unioned domains."""
    return judged_rows(spark, sf_dir).where("rejected").groupBy("report_period", "operator_id", "domain").agg(F.count("*").alias("rejected_rows"))


@query(
    "rejections_by_domain",
    f"""
WITH j AS ({_JUDGED_SQL}), g AS (SELECT * FROM (SELECT DISTINCT report_period FROM j) CROSS JOIN (VALUES ('orders'), ('lineitem')) d(domain))
SELECT g.report_period, g.domain, COUNT(j.rejected) FILTER (WHERE j.rejected) AS rows
FROM g LEFT JOIN j ON g.report_period = j.report_period AND g.domain = j.domain GROUP BY ALL
""",
)
def rejections_by_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows of every period for each domain, zero where none is rejected."""
    j = judged_rows(spark, sf_dir).where("report_period IS NOT NULL")
    counted = j.groupBy("report_period", "domain").agg(F.count(F.when(F.col("rejected"), 1)).alias("rows"))
    grid = audit.period_domain_grid(counted.select("report_period").distinct(), ["orders", "lineitem"]).drop("domain_order")
    return grid.join(counted, ["report_period", "domain"], "left").select("report_period", "domain", F.coalesce("rows", F.lit(0)).alias("rows"))


@query(
    "validation_totals",
    f"SELECT CAST(SUM(rows_processed) AS BIGINT) AS rows_processed, CAST(SUM(rows_validated) AS BIGINT) AS rows_validated, "
    f"CAST(SUM(rows_rejected) AS BIGINT) AS rows_rejected FROM ({ORACLES['validation_counts']})",
)
def validation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: totals over the run's validation results."""
    return audit.result_totals(validation_counts(spark, sf_dir))


# --- events -------------------------------------------------------------------------------


@query(
    "open_events_by_operator",
    f"""
SELECT report_period, operator_id, domain, severity, COUNT(*) AS open_events
FROM ({_REGISTRY_SQL}) WHERE status IN ('open', 'acknowledged') GROUP BY ALL
""",
)
def open_events_by_operator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open events by (period, operator, domain, severity), most first."""
    return marts.open_events_ranked(registry(spark, sf_dir))


# --- ledgers ------------------------------------------------------------------------------


@query(
    "run_ledger",
    """
SELECT 'run-' || strftime(o_orderdate, '%Y-%m') AS run_id, CASE WHEN COUNT(*) FILTER (WHERE o_orderstatus = 'P') > 0 THEN 'failed' ELSE 'success' END AS status,
       COUNT(*) AS records_processed, COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS records_failed,
       '{"source":"orders","first":{"order":' || MIN(o_orderkey) || '},"rows":' || COUNT(*) || ',"note":null}' AS metadata
FROM orders GROUP BY strftime(o_orderdate, '%Y-%m')
""",
)
def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A started and a finished row per month of orders; the latest state with merged metadata."""
    o = table(spark, sf_dir, "orders").groupBy(period_of("o_orderdate").alias("p")).agg(
        F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "P").alias("bad"), F.min("o_orderkey").alias("first"))
    at = F.to_timestamp(F.concat("p", F.lit("-01")))
    none = lambda t: F.lit(None).cast(t)
    start = o.select(
        F.concat(F.lit("run-"), "p").alias("run_id"), F.lit("orders").alias("dag_id"), none("string").alias("task_id"), at.alias("started_at"),
        none("timestamp").alias("completed_at"), F.lit("running").alias("status"), none("bigint").alias("records_processed"), none("bigint").alias("records_failed"),
        none("string").alias("error_message"), F.concat(F.lit('{"source":"orders","rows":0,"first":{"order":'), "first", F.lit("}}")).alias("metadata"))
    finish = o.select(
        F.concat(F.lit("run-"), "p").alias("run_id"), none("string").alias("dag_id"), none("string").alias("task_id"), none("timestamp").alias("started_at"),
        (at + F.expr("INTERVAL 1 HOUR")).alias("completed_at"), F.when(F.col("bad") > 0, "failed").otherwise("success").alias("status"),
        F.col("n").alias("records_processed"), F.col("bad").alias("records_failed"), none("string").alias("error_message"),
        F.concat(F.lit('{"rows":'), "n", F.lit(',"note":null}')).alias("metadata"))
    return audit.run_state(start.unionByName(finish)).select("run_id", "status", "records_processed", "records_failed", "metadata")


_KEYS_SQL = """
  SELECT DISTINCT CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'mobile' WHEN c_mktsegment = 'FURNITURE' THEN 'fixed_voice' ELSE 'fixed_broadband' END AS seg,
         c_mktsegment, c_nationkey, strftime(o_orderdate, '%Y-%m') AS p
  FROM orders JOIN customer ON o_custkey = c_custkey
"""


@query(
    "landing_inventory",
    f"""
WITH k AS (SELECT DISTINCT seg, CASE seg WHEN 'mobile' THEN 'OPA0' || (c_nationkey % 2 + 1) WHEN 'fixed_voice' THEN 'OPA03' ELSE 'OPA0' || (c_nationkey % 5 + 3) END AS op, p
           FROM ({_KEYS_SQL}))
SELECT seg AS service_segment, op AS operator_id, CASE WHEN GROUPING(d) = 0 THEN d END AS domain, COUNT(*) AS objects
FROM (SELECT *, 'subscribers' AS d FROM k) GROUP BY GROUPING SETS ((seg), (op), (d))
""",
)
def landing_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of the subscribers drop by segment, by operator and by domain, from their keys."""
    o = table(spark, sf_dir, "orders").select("o_custkey", period_of("o_orderdate").alias("p"))
    o = o.join(tb.customer_keys(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")).select("service_segment", "operator_id", "p").distinct()
    key = F.concat_ws("/", "service_segment", "operator_id", F.lit("subscribers"), F.replace("p", F.lit("-"), F.lit("/")), F.concat(F.lit("subscribers_"), "p", F.lit(".csv")))
    return landing.inventory(o.select(key.alias("key")))


# --- dashboard slices ---------------------------------------------------------------------


def _slice(name: str, group: list[str], measures: dict[str, tuple[str, str]], where: str = "TRUE") -> None:
    """One filtered aggregate over the KPI mart; measures are (Spark SQL, DuckDB SQL)."""
    oracle = f"SELECT {', '.join(group)}, {', '.join(f'CAST({sql} AS BIGINT) AS {m}' for m, (_, sql) in measures.items())} FROM ({_KPI_SQL}) WHERE {where} GROUP BY {', '.join(group)}"

    @query(name, oracle)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        k = _kpis(spark, sf_dir, "union").where(where)
        return marts.dashboard_slice(k, group, {m: F.expr(f"CAST({sql} AS BIGINT)") for m, (sql, _) in measures.items()})


_same = lambda **m: {k: (v, v) for k, v in m.items()}
_slice("dashboard_quality", ["report_period", "service_segment"], _same(
    complaints="SUM(qos_related_complaints)", critical="SUM(open_critical_quality_events)", operators="COUNT(*)"))
_slice("dashboard_operators", ["operator_id"], _same(
    subscribers="SUM(total_subscribers)", active="SUM(active_subscribers_30d)", periods="COUNT(DISTINCT report_period)", open_events="SUM(open_quality_events)"))
_slice("dashboard_revenue", ["report_period", "operator_id"], _same(
    revenue_cents="SUM(total_revenue_xaf) * 100", subscribers="SUM(total_subscribers)"), "service_segment <> 'MACHINERY'")


# --- period progress ----------------------------------------------------------------------


@query(
    "period_progress",
    """
WITH p AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS report_period FROM orders)
SELECT report_period, CAST(greatest(0, least(83, (CAST(report_period[1:4] AS INT) - 1993) * 12 + CAST(report_period[6:7] AS INT) - 1)) AS INT) AS months,
       round(greatest(0, least(83, (CAST(report_period[1:4] AS INT) - 1993) * 12 + CAST(report_period[6:7] AS INT) - 1)) / 83.0, 9) AS progress
FROM p
""",
)
def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of every order month between 1993-01 and 1999-12, from 0 to 1."""
    p = table(spark, sf_dir, "orders").select(period_of("o_orderdate").alias("report_period")).distinct()
    at = period_progress("report_period", "1993-01", "1999-12")
    return p.select("report_period", F.round(at * 83, 0).cast("int").alias("months"), F.round(at, 9).alias("progress"))

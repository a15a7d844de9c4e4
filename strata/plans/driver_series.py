"""Allocation, interpolation, clamping and round-value detection on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import series
from .driver_queries import _ORDER_FACTS_SQL, order_kpis
from .registry import pct_sql, query
from .tables import customers, order_facts, period_facts

GROWTH_RATE = 0.03
GROWTH_BASE_YEAR = 1998
SEASON_AMPLITUDE = 0.05
SMALL_CELL_MIN = 2
CLAMP_LO, CLAMP_HI = 1, 3


def _share_sql(part: str, total: str, scale: int = 6) -> str:
    q = f"((2 * CAST({part} AS HUGEINT) * {10 ** scale} + {total}) // (2 * {total}))"
    return f"CASE WHEN {total} = 0 THEN NULL ELSE CAST(CAST({q} AS DECIMAL(38,0)) / {10 ** scale} AS DECIMAL({scale + 2},{scale})) END"


_CUST_WEIGHT_SQL = """
  SELECT n.n_name AS operator_id, COUNT(*) AS customers
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name
"""


@query(
    "allocate_share",
    f"""
WITH f AS ({_ORDER_FACTS_SQL}),
pn AS (SELECT report_period, operator_id, COUNT(*) AS orders FROM f GROUP BY report_period, operator_id),
pt AS (SELECT report_period, COUNT(*) AS period_total FROM f GROUP BY report_period),
w AS ({_CUST_WEIGHT_SQL}),
g AS (
  SELECT pn.report_period, pn.operator_id, pn.orders, pt.period_total, w.customers
  FROM pn JOIN pt ON pn.report_period = pt.report_period JOIN w ON pn.operator_id = w.operator_id
),
s AS (SELECT report_period, SUM(customers) AS wsum FROM g GROUP BY report_period)
SELECT g.report_period, g.operator_id, g.orders, g.period_total, g.customers,
       CAST(CASE WHEN s.wsum = 0 THEN 0 ELSE (CAST(g.period_total AS HUGEINT) * g.customers) // s.wsum END AS BIGINT) AS allocated,
       {_share_sql('g.customers', 's.wsum')} AS weight_share
FROM g JOIN s ON g.report_period = s.report_period
""",
)
def allocate_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each period's order total allocated across the operators active in
    it by customer-count weights (floor), plus the exact weight share."""
    o = order_facts(spark, sf_dir)
    pn = o.groupBy("report_period", "operator_id").agg(F.count(F.lit(1)).alias("orders"))
    # period totals roll up from the (period, operator) counts: no second pass over the facts
    pt = pn.groupBy("report_period").agg(F.sum("orders").alias("period_total"))
    w = customers(spark, sf_dir).groupBy("operator_id").agg(F.count(F.lit(1)).alias("customers"))
    g = pn.join(pt, "report_period").join(w, "operator_id")
    a = series.allocate(g, "period_total", "customers", ["report_period"], "allocated")
    out = series.weights(a, "customers", ["report_period"], "weight_share", 6)
    return out.select("report_period", "operator_id", "orders", "period_total", "customers", "allocated", "weight_share")


_ANCHOR_SQL = f"""
  SELECT operator_id, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(SUM(o_totalprice) * 100 AS HUGEINT) AS u
  FROM ({_ORDER_FACTS_SQL}) f GROUP BY operator_id, year(o_orderdate)
"""


@query(
    "interpolate_anchors",
    f"""
WITH a AS ({_ANCHOR_SQL}),
b AS (SELECT MIN(year) AS lo, MAX(year) AS hi FROM a),
ops AS (SELECT DISTINCT operator_id FROM a),
t AS (
  SELECT ops.operator_id, CAST(y.year AS INTEGER) AS year, CAST(m.month AS INTEGER) AS month
  FROM ops, b, range(b.lo - 1, b.hi + 2) y(year), range(1, 13) m(month)
),
ty AS (SELECT DISTINCT operator_id, year FROM t),
lo AS (SELECT ty.operator_id, ty.year, MAX(a.year) AS ly FROM ty JOIN a ON a.operator_id = ty.operator_id AND a.year < ty.year GROUP BY ty.operator_id, ty.year),
up AS (SELECT ty.operator_id, ty.year, MIN(a.year) AS uy FROM ty JOIN a ON a.operator_id = ty.operator_id AND a.year > ty.year GROUP BY ty.operator_id, ty.year),
ends AS (SELECT operator_id, MIN(year) AS fy, MAX(year) AS lsy FROM a GROUP BY operator_id),
x AS (
  SELECT t.operator_id, t.year, t.month, cur.u AS cur, prv.u AS prev,
         lo.ly, la.u AS lu, up.uy, ua.u AS uu, ends.fy, fa.u AS fu, ends.lsy, lsa.u AS lsu
  FROM t
  LEFT JOIN a cur ON cur.operator_id = t.operator_id AND cur.year = t.year
  LEFT JOIN a prv ON prv.operator_id = t.operator_id AND prv.year = t.year - 1
  LEFT JOIN lo ON lo.operator_id = t.operator_id AND lo.year = t.year
  LEFT JOIN a la ON la.operator_id = t.operator_id AND la.year = lo.ly
  LEFT JOIN up ON up.operator_id = t.operator_id AND up.year = t.year
  LEFT JOIN a ua ON ua.operator_id = t.operator_id AND ua.year = up.uy
  JOIN ends ON ends.operator_id = t.operator_id
  JOIN a fa ON fa.operator_id = t.operator_id AND fa.year = ends.fy
  JOIN a lsa ON lsa.operator_id = t.operator_id AND lsa.year = ends.lsy
),
u AS (
  SELECT operator_id, year, month,
         CASE WHEN cur IS NOT NULL AND prev IS NULL THEN cur
              WHEN cur IS NOT NULL THEN (2 * (prev * (12 - month) + cur * month) + 12) // 24
              WHEN year < fy THEN fu
              WHEN year > lsy THEN lsu
              ELSE (2 * (lu * (uy - year) + uu * (year - ly)) + (uy - ly)) // (2 * (uy - ly))
         END AS units
  FROM x
),
v AS (SELECT operator_id, year, month, CAST(CAST(units AS DECIMAL(38,0)) / 100 AS DECIMAL(38,2)) AS interpolated FROM u)
SELECT operator_id, year, month, interpolated,
       CAST(1 + {SEASON_AMPLITUDE} * cos((1 - (CAST(month AS DOUBLE) - 6) / 6) * pi()) AS DECIMAL(10,6)) AS seasonal_factor,
       CAST(ROUND(CAST(interpolated AS DECIMAL(20,2))
                  * CAST(pow({1 + GROWTH_RATE}, year - {GROWTH_BASE_YEAR}) AS DECIMAL(12,6)), 2) AS DECIMAL(38,2)) AS grown
FROM v
""",
)
def interpolate_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly revenue anchors per operator to months (one year beyond each
    end to exercise clamping); R05 seasonal factor; R06 compound growth."""
    o = order_facts(spark, sf_dir)
    anchors = o.groupBy("operator_id", F.year("o_orderdate").alias("year")).agg(F.sum("o_totalprice").alias("value"))
    lo, hi = anchors.agg(F.min("year"), F.max("year")).first()
    ops = anchors.select("operator_id").distinct()
    targets = ops.select(
        "operator_id", F.explode(F.sequence(F.lit(lo - 1), F.lit(hi + 1))).alias("year")
    ).select("operator_id", "year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    v = series.interpolate_anchors(anchors, targets, ["operator_id"], scale=2)
    factor = series.compound_growth(F.lit(1.0), GROWTH_RATE, "year", GROWTH_BASE_YEAR).cast("decimal(12,6)")
    return v.select(
        "operator_id",
        "year",
        "month",
        "interpolated",
        series.seasonal_factor("month", SEASON_AMPLITUDE).cast("decimal(10,6)").alias("seasonal_factor"),
        F.round(F.col("interpolated").cast("decimal(20,2)") * factor, 2).cast("decimal(38,2)").alias("grown"),
    )


@query(
    "small_cells",
    f"""
WITH f AS ({_ORDER_FACTS_SQL}),
k AS (SELECT report_period, operator_id, service_segment, COUNT(*) AS total_orders FROM f
      GROUP BY report_period, operator_id, service_segment),
kept AS (SELECT * FROM k WHERE total_orders >= {SMALL_CELL_MIN}),
s AS (SELECT report_period, service_segment, SUM(total_orders) AS tot FROM kept GROUP BY report_period, service_segment)
SELECT kept.report_period, kept.operator_id, kept.service_segment, kept.total_orders,
       CAST(least(greatest(kept.total_orders, {CLAMP_LO}), {CLAMP_HI}) AS BIGINT) AS clamped_orders,
       {_share_sql('kept.total_orders', 's.tot')} AS order_share
FROM kept JOIN s ON kept.report_period = s.report_period AND kept.service_segment = s.service_segment
""",
)
def small_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R08 drop cells under a threshold, R07 clamp, and shares re-normalised to 1."""
    k = order_kpis(spark, sf_dir).select("report_period", "operator_id", "service_segment", "total_orders")
    kept = series.drop_small(k, "total_orders", SMALL_CELL_MIN)
    c = kept.withColumn("clamped_orders", series.clamp("total_orders", CLAMP_LO, CLAMP_HI).cast("bigint"))
    return series.weights(c, "total_orders", ["report_period", "service_segment"], "order_share", 6)


_FACTS_LINE_SQL = """
  SELECT n.n_name AS operator_id, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS price
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""


@query(
    "round_value_signal",
    f"""
SELECT operator_id, COUNT(price) AS "values", COUNT(*) FILTER (WHERE price * 2 = floor(price * 2)) AS round_values,
       CASE WHEN COUNT(price) = 0 THEN NULL ELSE
         {pct_sql('COUNT(*) FILTER (WHERE price * 2 = floor(price * 2))', 'COUNT(price)')} END AS round_share_pct
FROM ({_FACTS_LINE_SQL}) x GROUP BY operator_id
""",
)
def round_value_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R10 re-aimed as a detector: share of an operator's amounts on whole/half units."""
    return series.round_value_share(period_facts(spark, sf_dir), ["operator_id"], "l_extendedprice")

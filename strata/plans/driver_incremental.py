"""Marts kept by deltas, tests counted by a mart's own write, staging views; over the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dq, marts
from ..operators.incremental import IncrementalMart, MartSpec
from ..operators.key_sketch import KeySketch, absent
from ..session import ensure_checkpoint_dir, shared_scratch
from ..sources.sinks import staging_view
from .driver_queries import _CUST_SQL, _ORDER_FACTS_SQL
from .registry import avg_sql, pct_sql, query
from .tables import customers, money, order_facts, table

LOADS = ("01-10", "11-20", "21-31")  # days of the month: each load touches every month
LATEST_KEY = ["report_period", "operator_id", "service_segment", "o_orderpriority"]


@query(
    "incremental_mart",
    f"""
WITH f AS ({_ORDER_FACTS_SQL}),
n AS (SELECT *, row_number() OVER (PARTITION BY report_period, operator_id, service_segment, o_orderpriority
                                   ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth FROM f),
k AS (SELECT report_period, operator_id, COUNT(*) AS latest_orders, CAST(SUM(o_totalprice) AS DECIMAL(38,2)) AS latest_revenue,
             {avg_sql('o_totalprice', 2, 6, 'DECIMAL(22,6)')} AS avg_price
      FROM n WHERE nth = 1 GROUP BY report_period, operator_id),
t AS (SELECT report_period, SUM(latest_revenue) AS total FROM k GROUP BY report_period)
SELECT k.*, {pct_sql('k.latest_revenue', 't.total', unit=100)} AS revenue_share_pct
FROM k JOIN t ON k.report_period = t.report_period
""",
)
def incremental_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M01, M02, V37 by deltas: the latest order per (period, operator, segment, priority), loaded in three
    batches that replace earlier ones; count, revenue, average and share per (period, operator)."""
    ensure_checkpoint_dir(spark)
    root = shared_scratch(spark, f"incremental-{uuid.uuid4().hex[:12]}")
    day = F.dayofmonth("o_orderdate")
    facts = order_facts(spark, sf_dir).select(*LATEST_KEY, "o_totalprice", "o_orderdate", "o_orderkey")
    load = F.when(day <= 10, LOADS[0]).when(day <= 20, LOADS[1]).otherwise(LOADS[2])
    facts.withColumn("load", load).write.partitionBy("load").parquet(f"{root}/loads")
    spec = MartSpec(["report_period", "operator_id"], "latest_orders", {"latest_revenue": "o_totalprice"}, {"avg_price": "o_totalprice"})

    def shares(rows: DataFrame) -> DataFrame:
        return marts.add_shares(rows, ["report_period"], {"latest_revenue": "revenue_share_pct"}, cast_to={"latest_revenue": "decimal(22,2)"})

    kept = IncrementalMart(spark, f"{root}/mart", spec, LATEST_KEY, ["o_orderdate", "o_orderkey"], shares)
    loads = spark.read.parquet(f"{root}/loads")
    for name in LOADS:
        kept.apply(name, loads.where(F.col("load") == name).drop("load"))
    return kept.mart().select(
        "report_period", "operator_id", "latest_orders", F.col("latest_revenue").cast("decimal(38,2)").alias("latest_revenue"),
        F.col("avg_price").cast("decimal(22,6)").alias("avg_price"), "revenue_share_pct")


# --- D01-D04 counted by the write -------------------------------------------------------

TESTED_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE")  # two of the five are not accepted

_STANDING_SQL = f"""
  WITH u AS (SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS urgent_revenue
             FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey),
  c AS (SELECT c.*, CAST(x.c_acctbal AS DECIMAL(18,2)) AS balance FROM ({_CUST_SQL}) c JOIN customer x USING (c_custkey)),
  t AS (SELECT operator_id, service_segment, SUM(balance) AS total FROM c GROUP BY ALL)
  SELECT c.*, u.urgent_revenue, CASE WHEN total = 0 THEN 0 ELSE round(CAST(balance AS DOUBLE) / CAST(total AS DOUBLE) * 100, 4) END AS balance_share_pct
  FROM c JOIN t USING (operator_id, service_segment) LEFT JOIN u ON c_custkey = o_custkey
"""


@query(
    "observed_tests",
    f"""
WITH s AS ({_STANDING_SQL}),
r AS (
  SELECT 'not_null' AS test, 'operator_id' AS column_name, COUNT(*) FILTER (WHERE operator_id IS NULL) AS failures FROM s
  UNION ALL SELECT 'not_null', 'urgent_revenue', COUNT(*) FILTER (WHERE urgent_revenue IS NULL) FROM s
  UNION ALL SELECT 'accepted_values', 'service_segment', COUNT(*) FILTER (WHERE service_segment NOT IN {TESTED_SEGMENTS}) FROM s
  UNION ALL SELECT 'share_bounds', '', COUNT(*) FILTER (WHERE balance_share_pct < 0 OR balance_share_pct > 100) FROM s
  UNION ALL SELECT 'balance_nonnegative', '', COUNT(*) FILTER (WHERE balance < 0) FROM s
  UNION ALL SELECT 'urgent_revenue_nonnegative', '', COUNT(*) FILTER (WHERE urgent_revenue < 0) FROM s)
SELECT 'customer_standing' AS table_name, test, column_name, CAST(failures AS BIGINT) AS failures,
       CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM r
""",
)
def observed_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart of customers (balance, its share, revenue of urgent orders), tested by the write that stores it."""
    ensure_checkpoint_dir(spark)
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_totalprice").where("o_orderpriority = '1-URGENT'")
    urgent = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(money("o_totalprice")).alias("urgent_revenue"))
    cust = customers(spark, sf_dir).select("c_custkey", "operator_id", "service_segment", money("c_acctbal").alias("balance"))
    share = marts.add_shares(cust, ["operator_id", "service_segment"], {"balance": "balance_share_pct"}, cast_to={"balance": "decimal(22,2)"})
    return dq.write_tested(
        share.join(urgent, "c_custkey", "left"),
        shared_scratch(spark, f"standing-{uuid.uuid4().hex[:12]}/customer_standing"),
        "customer_standing",
        not_null=["operator_id", "urgent_revenue"],
        accepted={"service_segment": TESTED_SEGMENTS},
        failing={
            "share_bounds": (F.col("balance_share_pct") < 0) | (F.col("balance_share_pct") > 100),
            "balance_nonnegative": F.col("balance") < 0,
            "urgent_revenue_nonnegative": F.col("urgent_revenue") < 0,
        },
    )


# --- S22 ----------------------------------------------------------------------------------


@query(
    "staging_subscribers",
    f"""
SELECT o_orderkey AS silver_id, CAST(o_orderkey AS VARCHAR) AS bronze_id, operator_id, service_segment, o_orderpriority AS service_category,
       report_period, region_code, 1 AS total_subscribers, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS active_subscribers_30d,
       o_totalprice AS arpu_xaf, CAST(o_orderdate AS DATE) AS submitted_at, CAST(o_orderdate AS DATE) AS bronze_loaded_at,
       last_day(CAST(o_orderdate AS DATE)) AS silver_loaded_at
FROM ({_ORDER_FACTS_SQL})
""",
)
def staging_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The subscribers view over orders in silver form, whose other columns it leaves out."""
    f = order_facts(spark, sf_dir)
    day = F.col("o_orderdate").cast("date")
    silver = f.withColumns({
        "silver_id": F.col("o_orderkey"), "bronze_id": F.col("o_orderkey").cast("string"), "service_category": F.col("o_orderpriority"),
        "payment_type": F.col("o_orderstatus"), "technology": F.col("o_orderpriority"), "total_subscribers": F.lit(1),
        "active_subscribers_30d": F.when(F.col("o_orderstatus") == "O", 1).otherwise(0), "arpu_xaf": F.col("o_totalprice"),
        "submitted_at": day, "bronze_loaded_at": day, "silver_loaded_at": F.last_day(day)})
    return staging_view(silver, "subscribers")


# --- V02, J06, S10: keys against a growing set --------------------------------------------------

LAST_YEAR = "1998-01-01"
SKETCH_KEYS = 10_000_000  # layout for so many keys: 12.5 MB of bitmaps


@query(
    "first_seen_keys",
    f"""
SELECT CAST(o_custkey AS BIGINT) AS o_custkey, o_orderpriority, COUNT(*) AS orders
FROM orders o WHERE o_orderdate >= DATE '{LAST_YEAR}'
  AND NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_orderdate < DATE '{LAST_YEAR}' AND b.o_custkey = o.o_custkey AND b.o_orderpriority = o.o_orderpriority)
GROUP BY ALL
""",
)
def first_seen_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer, priority) pairs of the last year that no earlier order has, by a sketch of the earlier
    pairs that two loads filled, then the exact anti join for what the sketch lets through."""
    keys = ["o_custkey", "o_orderpriority"]
    orders = table(spark, sf_dir, "orders").select(*keys, "o_orderdate").withColumn("o_custkey", F.col("o_custkey").cast("bigint"))
    early = orders.where(F.col("o_orderdate") < F.lit("1995-01-01").cast("date"))
    later = orders.where((F.col("o_orderdate") >= F.lit("1995-01-01").cast("date")) & (F.col("o_orderdate") < F.lit(LAST_YEAR).cast("date")))
    layout = KeySketch(SKETCH_KEYS)
    sketch = layout.merge(layout.build(early.select(*keys)), layout.build(later.select(*keys)))
    known = orders.where(F.col("o_orderdate") < F.lit(LAST_YEAR).cast("date")).select(*keys)
    new = absent(orders.where(F.col("o_orderdate") >= F.lit(LAST_YEAR).cast("date")).select(*keys), keys, known, layout, sketch)
    return new.groupBy(*keys).agg(F.count("*").alias("orders"))

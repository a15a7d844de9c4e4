"""Readers for the driver's Parquet tables and their silver-shaped analogs.

The driver tables are a TPC-H-like star; the library's operators are
exercised on them by analogy:

* operator  = nation name (``n_name``)
* region    = region name (``r_name``)
* segment   = customer market segment (``c_mktsegment``)
* period    = calendar month of the fact's date
* money     = driver doubles cast to ``decimal(18,2)`` before any sum

Every reader selects only the columns it needs so Parquet scans stay pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import period_of

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def money(c: str) -> F.Column:
    return F.col(c).cast("decimal(18,2)")


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation with its region name."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer keyed attributes: operator (nation) and segment."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    n = nations(spark, sf_dir)
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        "c_custkey",
        "c_nationkey",
        F.col("n_name").alias("operator_id"),
        F.col("r_name").alias("region_code"),
        F.col("c_mktsegment").alias("service_segment"),
        "c_acctbal",
    )


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with period, operator, segment (customer join is a shuffle join:
    the customer side grows with the data, so it is never force-broadcast)."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    c = customers(spark, sf_dir).select("c_custkey", "operator_id", "region_code", "service_segment")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        money("o_totalprice").alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
        period_of("o_orderdate").alias("report_period"),
        "operator_id",
        "region_code",
        "service_segment",
    )


def period_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the ordering customer's operator/segment and the ship month."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_tax", "l_discount", "l_quantity", "l_shipdate"
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = customers(spark, sf_dir).select("c_custkey", "operator_id", "service_segment")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey, "inner")
        .join(c, F.col("o_custkey") == c.c_custkey, "inner")
        .select(
            "l_orderkey",
            "l_linenumber",
            money("l_extendedprice").alias("l_extendedprice"),
            money("l_tax").alias("l_tax"),
            money("l_discount").alias("l_discount"),
            "l_quantity",
            "l_shipdate",
            period_of("l_shipdate").alias("report_period"),
            "operator_id",
            "service_segment",
        )
    )


# Lifecycle states and how a driver event maps onto them (event_id modulo 4).
EVENT_STATUSES = ("open", "acknowledged", "resolved", "false_positive")


def event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the user's operator/segment (left join: unknown users keep null keys)."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    c = customers(spark, sf_dir).select("c_custkey", "operator_id", "service_segment")
    statuses = F.array(*[F.lit(s) for s in EVENT_STATUSES])
    return e.join(c, e.user_id == c.c_custkey, "left").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        "props",
        period_of("ts").alias("report_period"),
        "operator_id",
        "service_segment",
        F.when(F.col("event_type") == "error", "critical").otherwise("warning").alias("severity"),
        F.element_at(statuses, (F.col("event_id") % 4 + 1).cast("int")).alias("status"),
    )

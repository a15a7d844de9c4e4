"""Deterministic time-series and allocation operators.

All of them are column expressions, joins and aggregates. Integer
arithmetic is used where the result must round exactly (allocation floors,
interpolation to fixed decimals), so results do not depend on float order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import col_


def period_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Every ``YYYY-MM`` from ``first`` to ``last`` inclusive (both ``YYYY-MM``)."""
    seq = F.sequence(
        F.to_date(F.lit(first + "-01")), F.to_date(F.lit(last + "-01")), F.expr("INTERVAL 1 MONTH")
    )
    return spark.range(1).select(F.explode(seq).alias("d")).select(
        F.date_format("d", "yyyy-MM").alias("report_period"),
        F.year("d").alias("year"),
        F.month("d").alias("month"),
    )


def spine_from(df: DataFrame, period_col: str = "report_period") -> DataFrame:
    """R01 over the data's own range: min..max period of ``df`` (one small aggregate)."""
    bounds = df.agg(F.min(period_col).alias("lo"), F.max(period_col).alias("hi"))
    seq = F.sequence(
        F.to_date(F.concat("lo", F.lit("-01"))), F.to_date(F.concat("hi", F.lit("-01"))), F.expr("INTERVAL 1 MONTH")
    )
    return bounds.select(F.explode(seq).alias("d")).select(
        F.date_format("d", "yyyy-MM").alias("report_period"), F.year("d").alias("year"), F.month("d").alias("month")
    )


def group_totals(df: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """Attach ``sum(value)`` per group via aggregate + join (skew-proof, no window).

    Without a group the grand total is one scalar: it is computed first and
    added as a literal, so no single-partition window or cross join appears.
    """
    if group:
        t = df.groupBy(*group).agg(F.sum(value).alias(out))
        return df.join(t, list(group), "left")
    total = df.agg(F.sum(value)).first()[0]
    return df.withColumn(out, F.lit(total))


def allocate(
    df: DataFrame, total: str, weight: str, group: Sequence[str], out: str = "allocated"
) -> DataFrame:
    """``floor(total * w / sum(w))`` per group, 0 when the weights sum to 0.

    Integral ``total`` and ``weight`` are required; the division is integer
    (``div``), so the floor is exact.
    """
    t = group_totals(df, group, weight, "_wsum")
    alloc = F.when(F.col("_wsum") == 0, F.lit(0).cast("bigint")).otherwise(
        F.expr(f"(CAST({total} AS DECIMAL(38,0)) * CAST({weight} AS DECIMAL(38,0))) div CAST(_wsum AS DECIMAL(38,0))")
    )
    return t.withColumn(out, alloc.cast("bigint")).drop("_wsum")


def weights(df: DataFrame, value: str, group: Sequence[str] = (), out: str = "weight", scale: int = 6) -> DataFrame:
    """Value / sum(value) in the group as an exact decimal with ``scale`` digits."""
    t = group_totals(df, group, value, "_vsum")
    w = F.round(F.col(value).cast("decimal(20,0)") / F.col("_vsum").cast("decimal(20,0)"), scale)
    return t.withColumn(out, F.when(F.col("_vsum") == 0, None).otherwise(w).cast(f"decimal({scale + 2},{scale})")).drop(
        "_vsum"
    )


def interpolate_anchors(
    anchors: DataFrame,
    targets: DataFrame,
    keys: Sequence[str],
    scale: int = 2,
    value: str = "value",
    out: str = "interpolated",
) -> DataFrame:
    """Annual anchors -> monthly values.

    ``anchors``: (keys..., year, value) year-end values; ``targets``: (keys...,
    year, month). For an anchor year with a previous anchor the value moves
    linearly from the previous year-end: ``prev + m/12 * (cur - prev)``; without
    a previous anchor it is flat. Between anchors it is linear by year (month
    ignored); before the first / after the last anchor it is clamped.

    Values are non-negative decimals; the arithmetic runs on integers of
    ``10^-scale`` units and rounds half up once, at the end.
    """
    unit = 10**scale
    a = anchors.select(*keys, "year", (F.col(value) * unit).cast("decimal(38,0)").alias("_u"))
    per_key = a.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("year", "_u"))).alias("_a"))
    j = targets.join(per_key, list(keys), "left")
    arr, y, m = F.col("_a"), F.col("year"), F.col("month")
    as_map = F.map_from_entries(arr)
    cur, prev = F.element_at(as_map, y), F.element_at(as_map, y - 1)
    lower = F.array_max(F.filter(arr, lambda s: s["year"] < y))
    upper = F.array_min(F.filter(arr, lambda s: s["year"] > y))
    first, last = F.element_at(arr, 1), F.element_at(arr, -1)

    def rnd(num: Column, den: Column) -> Column:
        # round(num / den) half up; num >= 0, den > 0, both integral
        return F.floor((num * 2 + den) / (den * 2))

    in_year = F.when(prev.isNull(), cur).otherwise(rnd(prev * (F.lit(12) - m) + cur * m, F.lit(12)))
    gap = rnd(
        lower["_u"] * (upper["year"] - y) + upper["_u"] * (y - lower["year"]), (upper["year"] - lower["year"]).cast("decimal(38,0)")
    )
    units = (
        F.when(arr.isNull(), F.lit(None))
        .when(cur.isNotNull(), in_year)
        .when(y < first["year"], first["_u"])
        .when(y > last["year"], last["_u"])
        .otherwise(gap)
    )
    return j.select(*targets.columns, (units.cast("decimal(38,0)") / unit).cast(f"decimal(38,{scale})").alias(out))


def seasonal_factor(month: str | Column, amplitude: float = 0.05) -> Column:
    """``1 + a * cos((1 - (m - 6) / 6) * pi)``: peak in December, trough in June."""
    m = col_(month).cast("double")
    return F.lit(1.0) + F.lit(amplitude) * F.cos((F.lit(1.0) - (m - 6) / 6) * F.lit(math.pi))


def compound_growth(base: str | Column, rate: float, year: str | Column, base_year: int = 2024) -> Column:
    """``base * (1 + g) ^ (year - base_year)``."""
    return col_(base) * F.pow(F.lit(1.0 + rate), col_(year) - F.lit(base_year))


def clamp(c: str | Column, lo: float, hi: float) -> Column:
    """Bound a value to ``[lo, hi]``."""
    return F.least(F.greatest(col_(c), F.lit(lo)), F.lit(hi))


def drop_small(df: DataFrame, value: str, threshold: float) -> DataFrame:
    """Keep cells whose value reaches the threshold."""
    return df.filter(F.col(value) >= F.lit(threshold))


def on_half_units(c: str | Column) -> Column:
    """R10 predicate: value sits on a whole or half unit (decimal-exact)."""
    x = col_(c).cast("decimal(38,6)") * 2
    return x == F.floor(x)


def round_value_share(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """R10 detector: per group, rows, rows on whole/half units, and their share in %."""
    g = df.groupBy(*group).agg(
        F.count(F.col(value)).alias("values"), F.count_if(on_half_units(value)).alias("round_values")
    )
    share = F.round(F.col("round_values").cast("decimal(20,0)") * 100 / F.col("values").cast("decimal(20,0)"), 4)
    return g.withColumn("round_share_pct", F.when(F.col("values") == 0, None).otherwise(share).cast("decimal(10,4)"))


def operators_for_segment(operators: DataFrame, segment: str) -> DataFrame:
    """Operators licensed for a segment."""
    return operators.filter(F.array_contains("service_segments", segment))


def regions_in_zone(regions: DataFrame, zone: str | None = None, urban: bool | None = None) -> DataFrame:
    """Regions by zone and/or urban concentration."""
    out = regions
    if zone is not None:
        out = out.filter(F.col("zone") == zone)
    if urban is not None:
        out = out.filter(F.col("is_urban_concentration") == F.lit(urban))
    return out

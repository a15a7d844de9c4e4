"""Registry of named queries on the driver tables and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with optional SQL oracle."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: fn(tune(spark), sf_dir)
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco


def pct_sql(part: str, total: str, scale: int = 4, unit: int = 1) -> str:
    """DuckDB text for ``round(part / total * 100, scale)`` HALF_UP, exact.

    DuckDB divides decimals in double precision, so the oracle uses integer
    arithmetic instead: ``(2 * p * 10^(scale+2) + t) // (2 * t)`` on
    non-negative values, where ``unit`` scales money to integral cents.
    """
    p = f"CAST(({part}) * {unit} AS HUGEINT)"
    t = f"CAST(({total}) * {unit} AS HUGEINT)"
    q = f"((2 * {p} * {10 ** (scale + 2)} + {t}) // (2 * {t}))"
    return (
        f"CASE WHEN ({total}) = 0 THEN CAST(0 AS DECIMAL(10,{scale})) "
        f"ELSE CAST(CAST({q} AS DECIMAL(38,0)) / {10 ** scale} AS DECIMAL(10,{scale})) END"
    )


def avg_sql(expr: str, in_scale: int, out_scale: int, out_type: str) -> str:
    """DuckDB text for an exact HALF_UP decimal average of non-negative ``expr``.

    ``expr`` has ``in_scale`` decimals; it is summed as an integer of
    ``10^-in_scale`` units and divided with integer arithmetic, matching
    Spark's decimal ``avg`` (which keeps more digits before its final rounding).
    """
    s = f"SUM(CAST(({expr}) * {10 ** in_scale} AS HUGEINT))"
    n = f"COUNT({expr})"
    q = f"((2 * {s} * {10 ** (out_scale - in_scale)} + {n}) // (2 * {n}))"
    return f"CAST(CAST({q} AS DECIMAL(38,0)) / {10 ** out_scale} AS {out_type})"

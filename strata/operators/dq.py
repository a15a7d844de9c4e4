"""Data tests and source freshness.

All tests of one table run as a single aggregate of ``count_if`` columns,
then unpivot to one row per test; a test passes when it counts no failures.
``write_tested`` counts them while the table is written.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Freshness limits of the silver and audit sources.
WARN_AFTER_DAYS = 45
ERROR_AFTER_DAYS = 75


def _tests(
    not_null: Sequence[str], accepted: Mapping[str, Sequence[str]] | None, failing: Mapping[str, Column] | None
) -> list[tuple[str, str, Column]]:
    """(kind, column, predicate of failing rows) of every test."""
    tests: list[tuple[str, str, Column]] = []
    for c in not_null:
        tests.append(("not_null", c, F.col(c).isNull()))
    for c, values in (accepted or {}).items():
        tests.append(("accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(list(values))))
    for name, pred in (failing or {}).items():
        tests.append((name, "", pred))
    return tests


def _verdicts(rows: DataFrame, table: str) -> DataFrame:
    return rows.select(
        F.lit(table).alias("table_name"),
        "test",
        "column_name",
        F.col("failures").cast("bigint").alias("failures"),
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"),
    )


def data_tests(
    df: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
    failing: Mapping[str, Column] | None = None,
) -> DataFrame:
    """D01 ``not_null``, D02 ``accepted_values`` (nulls pass), D03/D04 singular tests
    given as named *failing-row* predicates. One pass over ``df``."""
    tests = _tests(not_null, accepted, failing)
    agg = df.agg(*[F.count_if(p).alias(f"_t{i}") for i, (_, _, p) in enumerate(tests)])
    rows = F.array(
        *[
            F.struct(F.lit(kind).alias("test"), F.lit(col).alias("column_name"), F.col(f"_t{i}").alias("failures"))
            for i, (kind, col, _) in enumerate(tests)
        ]
    )
    return _verdicts(agg.select(F.inline(rows)), table)


def write_tested(
    df: DataFrame,
    path: str,
    table: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
    failing: Mapping[str, Column] | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Writes ``df`` as Parquet and returns its test rows, counted by the write itself.

    The counts are observed in the tasks that write the rows, so the tests cost
    neither a second scan nor a second run of the mart. Spark counts each
    output partition once, also when its task ran again on another executor.
    Driver-side there is one number per test.
    """
    tests = _tests(not_null, accepted, failing)
    seen = Observation(f"tests of {table} {uuid.uuid4().hex}")
    observed = df.observe(seen, *[F.count_if(p).alias(f"t{i}") for i, (_, _, p) in enumerate(tests)]) if tests else df
    writer = observed.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    counts = seen.get if tests else {}
    rows = [(kind, col, counts[f"t{i}"]) for i, (kind, col, _) in enumerate(tests)]
    return _verdicts(df.sparkSession.createDataFrame(rows, "test string, column_name string, failures bigint"), table)


def freshness(
    sources: Mapping[str, tuple[DataFrame, str]],
    as_of: str | _dt.datetime,
    warn_days: int = WARN_AFTER_DAYS,
    error_days: int = ERROR_AFTER_DAYS,
) -> DataFrame:
    """Newest load time per source vs ``as_of``: pass / warn / error.

    Each source is one ``max`` aggregate; the sources are unioned (tiny).
    """
    parts = []
    for name, (df, ts_col) in sources.items():
        parts.append(df.agg(F.max(F.col(ts_col).cast("timestamp_ntz")).alias("max_loaded_at")).select(F.lit(name).alias("source"), "*"))
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    ref = F.lit(str(as_of)).cast("timestamp_ntz")
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), ref)
    status = (
        F.when(F.col("max_loaded_at").isNull(), "error")
        .when(age > error_days * 86400, "error")
        .when(age > warn_days * 86400, "warn")
        .otherwise("pass")
    )
    return allp.select("source", "max_loaded_at", age.cast("bigint").alias("age_seconds"), status.alias("status"))

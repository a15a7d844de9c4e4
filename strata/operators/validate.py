"""Validation: evaluate a rule list, split valid/rejected, count, build rejections.

``validate`` is one projection over the (incrementally filtered) bronze rows
joined to size-checked dimensions; the three outputs (valid rows, rejected
rows, counts) all derive from it. Callers that need more than one of them
should persist or stage the validated frame once (see ``stage``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import stable_id
from ..functions.periods import period_start
from .joins import lookup
from .rules import Rule, compile_codes, rejection_message

CODES = "rejection_codes"


@dataclass(frozen=True)
class DimLookup:
    """A left-joined reference table: adds ``{prefix}{right_key}`` and ``columns``."""

    dim: DataFrame
    left_key: str
    right_key: str
    columns: Sequence[str] = ()
    prefix: str = "dim_"


@dataclass
class RulePack:
    """Everything needed to validate one domain.

    ``rules`` may refer to lookup columns (``dim_*``) by name; ``derived`` are
    the silver-only computed columns; ``key`` is the business key for upserts.
    """

    name: str
    rules: Sequence[Rule]
    lookups: Sequence[DimLookup] = ()
    derived: dict[str, F.Column] = field(default_factory=dict)
    key: Sequence[str] = ()
    null_safe_key: bool = False
    pre: dict[str, F.Column] = field(default_factory=dict)


def validate_pack(df: DataFrame, pack: RulePack) -> DataFrame:
    """``validate`` with the pack's pre-computed columns added first."""
    return validate(df.withColumns(pack.pre) if pack.pre else df, pack.rules, pack.lookups)


def incremental(df: DataFrame, loaded_after: _dt.datetime | str | None, ts_col: str = "_loaded_at") -> DataFrame:
    """All rows when the bound is None, else rows at or after it (inclusive).

    The bound is resolved here, before the plan is built, so the comparison
    is a plain predicate Catalyst pushes into the Parquet scan.
    """
    if loaded_after is None:
        return df
    col_type = dict(df.dtypes).get(ts_col, "timestamp")
    return df.filter(F.col(ts_col) >= F.lit(str(loaded_after)).cast(col_type))


def validate(df: DataFrame, rules: Sequence[Rule], lookups: Sequence[DimLookup] = ()) -> DataFrame:
    """Add ``rejection_codes`` (array<string>, rule order) after dimension lookups.

    Dimension columns are dropped again so the output has the input columns
    plus the codes.
    """
    base_cols = df.columns
    joined = df
    for lk in lookups:
        joined = lookup(joined, lk.dim, lk.left_key, lk.right_key, lk.columns, lk.prefix)
    return joined.select(*[F.col(c) for c in base_cols], compile_codes(rules).alias(CODES))


def is_valid() -> F.Column:
    return F.size(F.col(CODES)) == 0


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) by the size of the code array."""
    return validated.filter(is_valid()), validated.filter(~is_valid())


def counts(validated: DataFrame, domain: str | None = None) -> DataFrame:
    """Processed / validated / rejected in one aggregate (one row)."""
    aggs = [
        F.count(F.lit(1)).alias("rows_processed"),
        F.count_if(is_valid()).alias("rows_validated"),
        F.count_if(~is_valid()).alias("rows_rejected"),
    ]
    out = validated.agg(*aggs)
    if domain is not None:
        out = out.select(F.lit(domain).alias("domain"), "*")
    return out


def run_all(results: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Union of per-domain counts in the given domain order."""
    frames = [counts(v, name).withColumn("domain_order", F.lit(i)) for i, (name, v) in enumerate(results)]
    return reduce(lambda a, b: a.unionByName(b), frames).orderBy("domain_order").drop("domain_order")


def rejections(rejected: DataFrame, run_id: str | None, id_col: str = "bronze_id", at: str | None = None) -> DataFrame:
    """V36/V38 rows: one rejection per source row, id derived from the source id."""
    rejected_at = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return rejected.select(
        stable_id(F.lit("rejection"), F.col(id_col)).alias("rejection_id"),
        F.col(id_col),
        rejection_message(F.col(CODES)).alias("rejection_reason"),
        F.col(CODES),
        rejected_at.alias("rejected_at"),
        F.lit(run_id).cast("string").alias("rejected_by_run_id"),
    )


def silver_rows(
    valid: DataFrame,
    run_id: str | None,
    derived: dict[str, F.Column] | None = None,
    period_col: str = "report_period",
    at: str | None = None,
) -> DataFrame:
    """V32 + lineage: valid rows with ``period_start_date``, derived totals and run stamps."""
    loaded = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    out = valid.drop(CODES, "_raw_payload", "_source_line", "_loaded_by_run_id")
    out = out.withColumnRenamed("_loaded_at", "bronze_loaded_at") if "_loaded_at" in out.columns else out
    extra = {
        "silver_id": stable_id(F.lit("silver"), F.col("bronze_id")) if "bronze_id" in valid.columns else F.lit(None),
        "period_start_date": period_start(F.col(period_col)),
        "validated_by_run_id": F.lit(run_id).cast("string"),
        "silver_loaded_at": loaded,
    }
    extra.update(derived or {})
    return out.withColumns(extra)

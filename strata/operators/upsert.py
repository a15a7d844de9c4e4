"""Upsert by business key on plain Parquet.

Plain Parquet has no MERGE, so an upsert is ``(existing anti-join incoming)
union incoming`` restricted to the partitions the batch touches, written to a
staging folder first and then swapped in with dynamic partition overwrite
(never overwriting a path that is being read).

Duplicates inside one batch are resolved last-wins by an explicit total
order. The pick is an aggregate (``max`` of a struct whose leading fields are
the order columns), not a window: aggregates combine map-side, so a business
key holding a third of the batch does not land whole in one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_scratch
from .joins import key_condition


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the row that is greatest by ``order`` (then by all columns).

    ``order`` columns are compared descending-wins (latest first). All other
    columns follow in the struct as a deterministic tie-break.
    """
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(
        *[oc.alias(f"_o{i}") for i, oc in enumerate(order_cols)],
        *[F.col(c).alias(f"_v_{c}") for c in rest],
    )
    picked = df.groupBy(*keys).agg(F.max(packed).alias("_pick"))
    return picked.select(*keys, *[F.col(f"_pick._v_{c}").alias(c) for c in rest]).select(*df.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in a batch, with their count (metric)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicates")).filter(F.col("duplicates") > 1)


def merge(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    order: Sequence[str | Column] | None = None,
    preserve: Sequence[str] = (),
) -> DataFrame:
    """Insert-or-replace: incoming rows win, existing rows without a match stay.

    ``order`` de-duplicates the incoming batch last-wins first. ``preserve``
    columns keep the existing value when a key matches (e.g. ``created_at``).
    """
    batch = latest_per_key(incoming, keys, order) if order else incoming
    kept = existing.join(batch.select(*keys), key_condition(existing, batch.select(*keys), keys, null_safe), "left_anti")
    if preserve:
        old = existing.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in preserve])
        cond = key_condition(batch, old, keys, null_safe)
        joined = batch.join(old, cond, "left")
        batch = joined.select(
            *[batch[k] for k in keys],
            *[
                (F.coalesce(F.col(f"_old_{c}"), batch[c]) if c in preserve else batch[c]).alias(c)
                for c in incoming.columns
                if c not in keys
            ],
        ).select(*incoming.columns)
    return kept.unionByName(batch.select(*existing.columns))


def upsert_table(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    partition_by: str | None = None,
    null_safe: bool = False,
    order: Sequence[str | Column] | None = None,
    preserve: Sequence[str] = (),
    stage_name: str | None = None,
) -> DataFrame:
    """Upsert ``incoming`` into the Parquet table at ``path`` and return the new table.

    Only partitions present in the batch are read, merged and replaced. The
    merged partitions are written to a staging folder under the shared
    checkpoint area first, so a lost executor or a failed write never leaves
    the target half-overwritten by a plan that is still reading it.
    """
    try:
        existing = spark.read.parquet(path)
        exists = True
    except AnalysisException as exc:  # first load
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        exists = False

    if not exists:
        batch = latest_per_key(incoming, keys, order) if order else incoming
        writer = batch.write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        return spark.read.parquet(path)

    if partition_by:
        touched = incoming.select(partition_by).distinct()
        existing = existing.join(touched, partition_by, "left_semi")
    merged = merge(existing, incoming, keys, null_safe, order, preserve)
    staging = shared_scratch(spark, f"stage-{stage_name or 'upsert'}-{uuid.uuid4().hex}")
    writer = merged.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(staging)
    staged = spark.read.parquet(staging)
    writer = staged.write.mode("overwrite")
    if partition_by:
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)
    else:
        writer.parquet(path)
    return spark.read.parquet(path)

"""Join helpers: dimension lookups, null-safe key matching, N-way outer merge.

No join is hinted: Spark broadcasts a side while its bytes are under the
threshold, adaptive execution decides again from what a side really holds, and
a larger side is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def key_condition(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False) -> Column:
    """Conjunction of key equalities; ``<=>`` when nulls must match each other."""
    parts = [left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k] for k in keys]
    return reduce(lambda a, b: a & b, parts)


def lookup(
    df: DataFrame,
    dim: DataFrame,
    left_key: str,
    right_key: str,
    columns: Sequence[str] = (),
    prefix: str = "dim_",
    unique: bool = True,
) -> DataFrame:
    """Left join a dimension, adding ``{prefix}{right_key}`` (null = not found) and columns.

    ``right_key`` is the dimension's key. Where it may repeat, ``unique=False``
    de-duplicates it first (a shuffle), so that the lookup never multiplies rows.
    """
    wanted = [right_key, *[c for c in columns if c != right_key]]
    side = dim.select(*[F.col(c).alias(prefix + c) for c in wanted])
    side = side if unique else side.dropDuplicates([prefix + right_key])
    return df.join(side, df[left_key] == side[prefix + right_key], "left")


def outer_merge(
    frames: Sequence[tuple[str, DataFrame]],
    keys: Sequence[str],
    form: str = "union",
) -> DataFrame:
    """Merge pre-aggregated frames on a composite key like a chain of FULL OUTER joins.

    Every frame must already be unique per key. Null keys never match (SQL
    equality), so each null-key row stays on its own.

    ``form="union"``: one shuffle. Rows are unioned and grouped by the keys plus
    a tag that is the frame name whenever a key is null (so null-key rows of
    different frames stay apart) and null otherwise. Measure columns must be
    distinct across frames; each group takes the single non-null value.

    ``form="join"``: the literal chain ``f1 FULL JOIN f2 ON keys FULL JOIN f3 ON
    coalesce(f1.k, f2.k) = f3.k ...``; one exchange per join.
    """
    if form == "union":
        tagged = []
        for name, df in frames:
            any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
            tagged.append(df.withColumn("_merge_tag", F.when(any_null, F.lit(name))))
        allc = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
        measures = [c for c in allc.columns if c not in (*keys, "_merge_tag")]
        return allc.groupBy(*keys, "_merge_tag").agg(*[F.first(c, ignorenulls=True).alias(c) for c in measures]).drop(
            "_merge_tag"
        )
    if form != "join":
        raise ValueError(f"unknown form {form!r}")
    (first_name, acc), *rest = frames
    acc = acc.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in acc.columns if c not in keys])
    for _name, df in rest:
        right = df.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in df.columns if c not in keys])
        cond = reduce(lambda a, b: a & b, [acc[f"_k_{k}"] == right[f"_r_{k}"] for k in keys])
        joined = acc.join(right, cond, "full")
        acc = joined.select(
            *[F.coalesce(F.col(f"_k_{k}"), F.col(f"_r_{k}")).alias(f"_k_{k}") for k in keys],
            *[c for c in joined.columns if not c.startswith(("_k_", "_r_"))],
        )
    return acc.select(*[F.col(f"_k_{k}").alias(k) for k in keys], *[c for c in acc.columns if not c.startswith("_k_")])

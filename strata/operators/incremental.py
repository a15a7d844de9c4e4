"""Marts kept by deltas (M01, M02, T01): an upsert of facts costs what it touches.

An upsert replaces rows by business key. Its effect on a mart of sums, counts
and averages is a sum of signed rows: each replaced fact is retracted, each
incoming one inserted. Only these signed rows are aggregated; the sums per
batch, mart key and period go to a log, and a mart row is the sum of its log
rows. Averages are kept as a sum and a count. Shares of a period's total are
made anew for touched periods. Facts and mart are partitioned by period, log
and staging folders by batch. The touched periods of a batch are listed first
(months, so a bounded list) and reach the scans as a partition filter (facts) or
a pushed filter on sorted rows (log): other periods are not read.

A batch has four steps: its log rows, the merged facts of touched periods in a
staging folder, their swap into the facts, the refresh of the mart. The first two
are made from the facts before the swap and are skipped when a finished copy of
them exists, the last two can be repeated, and a marker closes the batch. So a
run that died anywhere is finished by calling ``apply`` with the same batch
again, and a batch that is done is passed over. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.objects import file_system
from .joins import key_condition
from .upsert import latest_per_key, merge

SIGN = "_sign"
ROWS = "_rows"


def changes(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Signed rows of an upsert: existing rows that ``incoming`` replaces with -1, its own rows with +1.

    ``incoming`` holds a key once. A key with a null replaces nothing unless ``null_safe``.
    """
    wanted = incoming.select(*keys)
    replaced = existing.join(wanted, key_condition(existing, wanted, keys, null_safe), "left_semi")
    signed = lambda df, sign: df.select(*incoming.columns, F.lit(sign).alias(SIGN))
    return signed(replaced, -1).unionByName(signed(incoming, 1))


@dataclass(frozen=True)
class MartSpec:
    """A mart by ``keys`` (the period among them): row count, sums and averages by output name."""

    keys: Sequence[str]
    count: str
    sums: Mapping[str, str] = field(default_factory=dict)
    averages: Mapping[str, str] = field(default_factory=dict)
    period: str = "report_period"

    def measures(self) -> list[str]:
        return sorted({*self.sums.values(), *self.averages.values()})

    def delta(self, signed: DataFrame) -> DataFrame:
        """Sums of signed rows per mart key; keys that a batch leaves as they were have a row of zeros."""
        aggs = [F.sum(SIGN).cast("bigint").alias(ROWS)]
        for m in self.measures():
            if isinstance(signed.schema[m].dataType, (T.DoubleType, T.FloatType)):
                raise ValueError(f"{m} is floating point, which does not retract exactly: cast it to decimal")
            aggs.append(F.sum(F.when(F.col(SIGN) < 0, -F.col(m)).otherwise(F.col(m))).alias(f"_sum_{m}"))
            aggs.append(F.coalesce(F.sum(F.when(F.col(m).isNotNull(), F.col(SIGN))), F.lit(0)).cast("bigint").alias(f"_n_{m}"))
        return signed.groupBy(*self.keys).agg(*aggs)

    def rows(self, log: DataFrame) -> DataFrame:
        """Mart rows as sums of log rows. Keys without facts are left out; sums and averages of nulls alone are null."""
        names = [c for c in log.columns if c.startswith("_")]
        total = log.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in names]).where(F.col(ROWS) > 0)
        some = lambda m, value: F.when(F.col(f"_n_{m}") > 0, value)
        scale = lambda m: getattr(log.schema[f"_sum_{m}"].dataType, "scale", 0)
        return total.select(
            *self.keys,
            F.col(ROWS).cast("bigint").alias(self.count),
            *[some(m, F.col(f"_sum_{m}")).alias(out) for out, m in self.sums.items()],
            *[some(m, F.col(f"_sum_{m}").cast(f"decimal(28,{scale(m)})") / F.col(f"_n_{m}").cast("decimal(20,0)")).alias(out)
              for out, m in self.averages.items()],
        )


class IncrementalMart:
    """Facts, delta log and mart under one root folder.

    ``keys`` is the business key, the period among them; rows of a batch that share it are resolved
    by ``order``, greatest first. ``finish`` derives further columns of the mart
    (shares) from the rows of whole periods. A batch's rows without a period are an error.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        spec: MartSpec,
        keys: Sequence[str],
        order: Sequence[str | Column],
        finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        null_safe: bool = False,
    ):
        if spec.period not in keys or spec.period not in spec.keys:
            raise ValueError(f"{spec.period} must be part of the business key and of the mart key")
        self.spark, self.root, self.spec, self.keys = spark, root.rstrip("/"), spec, list(keys)
        self.order, self.finish, self.null_safe = order, finish, null_safe
        self.fs, self.base = file_system(self.root)

    def _is(self, name: str) -> bool:
        return self.fs.get_file_info(f"{self.base}/{name}").type != pafs.FileType.NotFound

    def _read(self, name: str, schema: T.StructType, periods: Sequence[str]) -> DataFrame:
        """The given periods of a table; empty where it does not exist yet."""
        if not self._is(name):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        return rows.where(F.col(self.spec.period).isin(list(periods)))

    def _write(self, df: DataFrame, name: str, swap: bool = False) -> None:
        """Writes a folder anew, with its success marker, or (``swap``) replaces the periods that ``df`` holds."""
        period, path = self.spec.period, f"{self.root}/{name}"
        if swap:
            rows = df.hint("rebalance", period).write.mode("overwrite").partitionBy(period)
            rows.option("partitionOverwriteMode", "dynamic").parquet(path)
        else:
            df.sortWithinPartitions(period).write.mode("overwrite").parquet(path)

    def log(self, schema: T.StructType, periods: Sequence[str]) -> DataFrame:
        """Log rows of the given periods from all finished batches."""
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.base}/log", allow_not_found=True))
        done = [i.base_name for i in found if self._is(f"log/{i.base_name}/_SUCCESS")]
        rows = self.spark.read.schema(schema).parquet(*[f"{self.root}/log/{n}" for n in done])
        return rows.where(F.col(self.spec.period).isin(list(periods)))

    def apply(self, batch: str, incoming: DataFrame) -> list[str]:
        """Upserts one batch into facts and mart; the periods it touched. Safe to call again."""
        marker = f"applied/{batch}.json"
        if self._is(marker):
            with self.fs.open_input_stream(f"{self.base}/{marker}") as f:
                return json.loads(f.read())
        period = self.spec.period
        rows = latest_per_key(incoming, self.keys, self.order)
        periods = [r[0] for r in incoming.select(period).distinct().collect()]
        if None in periods:
            raise ValueError(f"rows without {period} cannot be placed")
        before = self._read("facts", rows.schema, periods)
        delta = self.spec.delta(changes(before, rows, self.keys, self.null_safe))
        if not self._is(f"log/batch={batch}/_SUCCESS"):
            self._write(delta, f"log/batch={batch}")
        if not self._is(f"stage/batch={batch}/_SUCCESS"):
            self._write(merge(before, rows, self.keys, self.null_safe).select(*rows.columns), f"stage/batch={batch}")
        self._write(self._read(f"stage/batch={batch}", rows.schema, periods), "facts", swap=True)
        self.refresh(delta.schema, periods)
        self.fs.create_dir(f"{self.base}/applied", recursive=True)
        with self.fs.open_output_stream(f"{self.base}/{marker}") as f:
            f.write(json.dumps(sorted(periods)).encode())
        return sorted(periods)

    def refresh(self, schema: T.StructType, periods: Sequence[str]) -> None:
        """Makes the mart's rows of the given periods anew from the log."""
        self._write(self.finish(self.spec.rows(self.log(schema, periods))), "mart", swap=True)

    def mart(self) -> DataFrame:
        """The mart as it is now; a period reads as the text it was written as."""
        path = f"{self.root}/mart"
        found = self.spark.read.parquet(path).schema
        text = [T.StructField(f.name, T.StringType() if f.name == self.spec.period else f.dataType) for f in found]
        return self.spark.read.schema(T.StructType(text)).parquet(path)

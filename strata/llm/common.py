"""Shared helpers: reading tables, staging intermediate tables, Arrow text buffers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import shared_scratch

# Word separators of every contract here: space and the controls 0x09-0x0D.
# ``bytes.split()`` separates on exactly these.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a session: workers need not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        _SHIPPED.add(sc.applicationId)
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        folder = tempfile.mkdtemp(prefix="strata-ship-")  # the driver's own; Spark serves the archive from here
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.addPyFile(shutil.make_archive(f"{folder}/strata-{sc.applicationId}", "zip", root, "strata"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Intermediate tables in the shared checkpoint folder, one sub-folder per operator call.

    A saved table cuts the lineage: a lost executor only costs the tasks that
    read it. Tables are dropped by ``drop`` once they are no longer read, the
    rest when the session's Python process ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = shared_scratch(spark, f"{name}-{uuid.uuid4().hex[:12]}")
        self._n = 0
        _OPEN.add(self)

    def save(self, df: DataFrame, compression: str = "zstd") -> DataFrame:
        path = f"{self.root}/t{self._n}"
        self._n += 1
        df.write.option("compression", compression).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        self._delete(df._scratch_path)

    def _delete(self, path: str) -> None:
        jvm, sc = self.spark._jvm, self.spark.sparkContext
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hadoop_path, True)


_OPEN: set = set()


@atexit.register
def _drop_all() -> None:
    for scratch in list(_OPEN):
        try:
            scratch._delete(scratch.root)
        except Exception:  # the session is gone: its folder goes with it
            pass


def text_keys(text: Column) -> list[Column]:
    """128 bits that name a text: two seeds of XXH64. Null and empty texts get the same key."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("k1"), F.xxhash64(F.lit(1), t).alias("k2")]


def first_per_task(df: DataFrame) -> DataFrame:
    """Map-side collapse of exact copies: rows whose (k1, k2) came before in the same task go.

    What is left holds each text at least once and at most once a task, so a
    text that fills a third of the table no longer weighs on any shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for b in batches:
            keep = []
            for i, key in enumerate(zip(b.column("k1").to_pylist(), b.column("k2").to_pylist())):
                if key not in seen:
                    seen.add(key)
                    keep.append(i)
            yield b if len(keep) == b.num_rows else b.take(pa.array(keep, pa.int64()))

    return df.mapInArrow(run, df.schema)


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche on 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h

"""Finalised objects leave the landing (S16): copy, manifest, delete, each safe to repeat.

The ledger says what is finalised. Tasks copy these objects, loaded and quarantined ones
to different roots, into a part file that is renamed when its SHA-256 equals the ledger's,
and give status and reason along as object metadata where the file system keeps such. A
copy's outcome is a row of the run's manifest, a Parquet table. Only what a finished
manifest calls copied is deleted, and only while the copy is there. A run
that died before its manifest copies again; one that died after it is closed by the next
run first. An object that was replaced after its ingestion differs from the ledger's
checksum and stays in the landing with the outcome ``changed``.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import listing
from .listing import file_system

BLOCK = 4 << 20
REASON_MAX = 500
MANIFEST = "key string, path string, target string, status string, reason string, bytes bigint, sha256 string, outcome string"
COPIED, CHANGED, GONE = "copied", "changed", "gone"


def finalised(ledger: DataFrame) -> DataFrame:
    """The latest loaded or quarantined row of each key."""
    done = ledger.where(F.col("status").isin("loaded", "quarantined"))
    last = F.max(F.struct("ingested_at", "status", "error_message", "file_checksum_sha256", "file_size_bytes")).alias("l")
    return done.groupBy(F.col("source_file").alias("key")).agg(last).select(
        "key", F.col("l.status").alias("status"), F.substring("l.error_message", 1, REASON_MAX).alias("reason"),
        F.col("l.file_size_bytes").alias("bytes"), F.col("l.file_checksum_sha256").alias("sha256"))


def digest(fs: pafs.FileSystem, path: str) -> str:
    found = hashlib.sha256()
    with fs.open_input_stream(path) as f:
        while block := f.read(BLOCK):
            found.update(block)
    return found.hexdigest()


def copy_object(source: str, target: str, sha256: str, metadata: dict[str, str]) -> str:
    """Copies one object by way of a part file of this attempt; the outcome."""
    from_fs, from_path = file_system(source)
    to_fs, to_path = file_system(target)
    if from_fs.get_file_info(from_path).type != pafs.FileType.File:
        return GONE
    if to_fs.get_file_info(to_path).type == pafs.FileType.File and digest(to_fs, to_path) == sha256:
        return COPIED if digest(from_fs, from_path) == sha256 else CHANGED
    to_fs.create_dir(to_path.rsplit("/", 1)[0], recursive=True)
    part = f"{to_path}.part-{uuid.uuid4().hex}"
    found = hashlib.sha256()
    with from_fs.open_input_stream(from_path) as f, to_fs.open_output_stream(part, metadata=metadata) as out:
        while block := f.read(BLOCK):
            found.update(block)
            out.write(block)
    if found.hexdigest() != sha256:
        to_fs.delete_file(part)
        return CHANGED
    to_fs.move(part, to_path)
    return COPIED


def delete_object(source: str, target: str, size: int) -> str:
    """Deletes a copied object from the landing while its copy is whole; ``kept`` otherwise."""
    to_fs, to_path = file_system(target)
    info = to_fs.get_file_info(to_path)
    if info.type != pafs.FileType.File or info.size != size:
        return "kept"
    fs, path = file_system(source)
    if fs.get_file_info(path).type == pafs.FileType.File:
        try:
            fs.delete_file(path)
        except FileNotFoundError:  # another attempt of this task
            pass
    return "moved"


def _each(outcome):
    """Arrow rows with their ``outcome`` by a function of the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            found = pa.array([outcome(r) for r in rows], pa.string())
            yield b.set_column(b.schema.get_field_index("outcome"), "outcome", found)

    return run


_copied = _each(lambda r: copy_object(r["path"], r["target"], r["sha256"], {"ingestion-status": r["status"], "quarantine-reason": r["reason"] or ""}))
_deleted = _each(lambda r: delete_object(r["path"], r["target"], r["bytes"]) if r["outcome"] == COPIED else r["outcome"])


class Archive:
    """Moves from ``landing`` to ``loaded`` and ``quarantine``; manifests and results are kept under ``state``."""

    def __init__(self, spark: SparkSession, landing: str, loaded: str, quarantine: str, state: str, tasks: int = 200):
        self.spark, self.landing, self.state, self.tasks = spark, landing.rstrip("/"), state.rstrip("/"), tasks
        self.roots = {"loaded": loaded.rstrip("/"), "quarantined": quarantine.rstrip("/")}
        self.fs, self.base = file_system(self.state)

    def _is(self, name: str) -> bool:
        return self.fs.get_file_info(f"{self.base}/{name}/_SUCCESS").type == pafs.FileType.File

    def open_runs(self) -> list[str]:
        """Runs with a finished manifest and no result."""
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.base}/manifest", allow_not_found=True))
        names = sorted(i.base_name for i in found)
        return [n for n in names if self._is(f"manifest/{n}") and not self._is(f"result/{n}")]

    def copy(self, run: str, ledger: DataFrame) -> None:
        """Copies what is finalised and still in the landing; writes the manifest."""
        have = listing.objects(self.spark, self.landing).select("path", "key")
        root = F.when(F.col("status") == "loaded", self.roots["loaded"]).otherwise(self.roots["quarantined"])
        plan = have.join(finalised(ledger), "key").withColumn("target", F.concat_ws("/", root, "key")).withColumn("outcome", F.lit(None).cast("string"))
        plan = plan.select(*[c.split(" ")[0] for c in MANIFEST.split(", ")]).repartition(self.tasks, "key")
        plan.mapInArrow(_copied, MANIFEST).write.mode("overwrite").parquet(f"{self.state}/manifest/{run}")

    def close(self, run: str) -> None:
        """Deletes what the run's manifest calls copied; writes the result."""
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.state}/manifest/{run}").repartition(self.tasks, "key")
        rows.mapInArrow(_deleted, MANIFEST).write.mode("overwrite").parquet(f"{self.state}/result/{run}")

    def run(self, run: str, ledger: DataFrame) -> DataFrame:
        """Closes earlier runs, then copies and deletes; a row per object of this run with its outcome: moved, changed, gone, kept."""
        for earlier in self.open_runs():
            self.close(earlier)
        if not self._is(f"result/{run}"):
            self.copy(run, ledger)
            self.close(run)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.state}/result/{run}")


# executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

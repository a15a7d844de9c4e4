"""Session helpers: one place for the Spark settings the library relies on.

On a cluster the session is created by the platform; ``tune`` only fills in
settings that are unset, so cluster-level choices (shuffle partitions sized
for the data, checkpoint folder on shared storage) always win.
"""

from __future__ import annotations

import os
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

# Settings the operators assume. Applied only when the key is not set yet.
DEFAULTS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the JVM never compiles a larger method: the rules of a wide domain in one would be interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Fill in library defaults that the platform's configuration leaves unset.

    Spark's own default of a key does not count as set: without this the
    session time zone would be the machine's.
    """
    given = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if not given.contains(key) and spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "strata", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench: UI off, small shuffle count."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.ansi.enabled", "true")
        # local disk only: commit task output straight into place (fewer renames per small file)
        .config("spark.hadoop.mapreduce.fileoutputcommitter.algorithm.version", "2")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names a shared folder there. Only in a local session, where
    driver and executors are one process, a scratch folder is created when it
    is unset; anywhere else that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="strata-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint area for staged tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of a few rows as part of the plan: Spark knows its size, so a join needs no shuffle to find it out."""
    fields = StructType.fromDDL(schema)
    columns = [pa.array([r[i] for r in rows], to_arrow_type(f.dataType)) for i, f in enumerate(fields)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=fields.names), fields)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Removes a staged folder that nothing reads any more."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)

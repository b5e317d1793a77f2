"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F

# Skewed joins are split and small shuffles merged at run time; joins turn into
# broadcast joins only when Spark has measured the side to be small.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the grouping after it then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # Landed records may repeat a field; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # An overwrite replaces the partitions it brings rows for; a column that an insert lacks is an error, not NULL.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.defaultColumn.useNullsForMissingDefaultValues": "false",
    "spark.sql.session.timeZone": "UTC",
}

SHUFFLE_TARGET_BYTES = 200 * 1024 * 1024

_own_folders: dict[str, str] = {}
_scope: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def build_session(app: str = "harborline", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    builder = builder.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-", dir="/tmp"))
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    """The run-time settings the operators rely on, on a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """Shuffle width that keeps a reducer near 200 MB, in whole waves of tasks."""
    wanted = max(1, math.ceil(input_bytes / SHUFFLE_TARGET_BYTES))
    return math.ceil(wanted / cores) * cores


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint folder.

    Only a local session with none configured gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="harborline-", dir="/tmp")
    return _own_folders[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/harborline/{name}-{uuid.uuid4().hex}"
    if _scope.get() is not None:
        _scope.get().append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete, at the end, every scratch folder that was made inside the block."""
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in made:
            folder, files = hadoop_path(spark, path)
            files.delete(folder, True)


def hadoop_path(spark: SparkSession, path: str):
    """A path as Hadoop sees it, and the file system it lives on."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def spread(df: DataFrame, partition_by=()) -> DataFrame:
    """Even out a frame before it is written into partition folders.

    Rows of one folder come together, so that a folder gets few files, but a folder that
    holds much of the table is split over several tasks again.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a result once and go on from the written table.

    Used where several passes follow: the passes read pruned columns of Parquet
    in place of repeating the joins above it, and a lost executor costs a re-read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    spread(df, partition_by).write.partitionBy(*partition_by).parquet(path)
    partitions = [f for f in df.schema if f.name in partition_by]
    columns = [f for f in df.schema if f.name not in partition_by]
    schema = type(df.schema)(columns + partitions)
    return spark.read.schema(schema).parquet(path).select(*df.columns)

"""What the operators of this subpackage share: session settings, the documents table, Arrow passes, written tables."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from harborline.session import apply_settings, scratch_path, stage

__all__ = ["arrow_map", "documents", "holding", "keep_rows", "prepare", "scratch_path", "stage", "stage_packed", "whole_text"]

# Documents are long: few of them in one Arrow batch keep a Python worker's memory small.
ARROW_ROWS = 500

# White space between words: these characters and no others.
SPACES = r"[\x20\x09-\x0D]"


# Python workers import this package; a worker started elsewhere needs to know where it is.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> SparkSession:
    apply_settings(spark)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, *paths]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(name: str = "text"):
    """The text of a row; a null one counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def stage_packed(df: DataFrame, name: str) -> DataFrame:
    """A table written once for several passes, like `stage`, packed tighter: for columns of ids or bits."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def holding() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Gives a function that holds a frame on the executors' disks for several passes, until the block ends.

    For frames that are not read after the block and come out the same if a part is lost and made again. Unlike `stage`
    it creates no files in the shared folder: on a local file system Hadoop starts a process for each file it creates.
    """
    held: list[DataFrame] = []

    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.DISK_ONLY))
        return held[-1]

    try:
        yield hold
    finally:
        for df in reversed(held):
            df.unpersist()


def arrow_map(df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """One Arrow batch in, one out, in parallel over the partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (made := make(batch)) is not None:
                yield made

    return df.mapInArrow(run, schema)


def keep_rows(df: DataFrame, text: str, verdict: Callable[[list[str]], list[bool]]) -> DataFrame:
    """The rows whose text the verdict keeps, with all their columns as they are, whatever their names."""
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                texts = [t or "" for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(verdict(texts), pa.bool_()))

    return df.mapInArrow(run, df.schema)

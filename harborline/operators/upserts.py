"""Keyed merges as joins: the new content of a table from its old content and a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


class KeyViolation(ValueError):
    """Rows that break the key of a table."""


def key_violations(df: DataFrame, keys) -> DataFrame:
    """Keys that are incomplete or occur more than once, with their row count."""
    incomplete = F.lit(False)
    for key in keys:
        incomplete = incomplete | F.col(key).isNull()
    counts = df.groupBy(*keys).agg(F.count("*").alias("rows"))
    return counts.where((F.col("rows") > 1) | incomplete)


def assert_key(df: DataFrame, keys, what: str) -> DataFrame:
    """Fail unless the keys are complete and unique; returns the frame."""
    found = key_violations(df, keys).take(3)
    if found:
        shown = "; ".join(str(row.asDict()) for row in found)
        raise KeyViolation(f"{what}: key ({', '.join(keys)}) broken, e.g. {shown}")
    return df


def upsert(target: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """Batch rows, and the target rows whose key is not in the batch."""
    untouched = target.join(batch.select(*keys), list(keys), "left_anti")
    return untouched.select(*target.columns).unionByName(batch.select(*target.columns))


def last_wins(batch: DataFrame, keys, position) -> DataFrame:
    """One row per key: the one that came last by ``position`` columns.

    An aggregation, not a window: each task reduces a repeated key to one row before
    the shuffle, so a key that fills a third of the batch is no hot spot.
    """
    rest = [c for c in batch.columns if c not in keys and c not in position]
    picked = F.max_by(F.struct(*rest), F.struct(*position)).alias("row")
    return batch.groupBy(*keys).agg(picked).select(*keys, "row.*")


def partial_upsert(target: DataFrame, batch: DataFrame, keys, refresh) -> DataFrame:
    """Insert new keys whole; for known keys take over only the ``refresh`` columns.

    Which side a row came from is carried as a marker, since any other column may be NULL.
    """
    old = target.withColumn("_old", F.lit(True)).alias("old")
    new = batch.withColumn("_new", F.lit(True)).alias("new")
    joined = old.join(new, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys], "full_outer")

    def merged(name: str):
        kept, given = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name in keys:
            return F.coalesce(kept, given)
        if name in refresh:
            return F.when(F.col("_new").isNull(), kept).otherwise(given)
        return F.when(F.col("_old").isNull(), given).otherwise(kept)

    return joined.select(*[merged(c).alias(c) for c in target.columns])


def insert_ignore(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Set union: batch rows are added unless an equal row is there already."""
    return target.unionByName(batch.select(*target.columns)).distinct()

"""The registry beside the data: assets, fields, lineage edges and check results."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from harborline.functions.columns import schema_of, table_of
from harborline.sinks.tables import TableStore

ASSET_TABLE, FIELD_TABLE = "registry.assets", "registry.fields"
EDGE_TABLE, CHECK_TABLE = "registry.edges", "registry.quality_checks"
METRIC_TABLE, UNLISTED_TABLE = "registry.write_metrics", "registry.unlisted_fields"
SKETCH_TABLE = "registry.distinct_sketches"
TABLES = (ASSET_TABLE, FIELD_TABLE, EDGE_TABLE, CHECK_TABLE, METRIC_TABLE, UNLISTED_TABLE, SKETCH_TABLE)
FEEDS = "feeds"


@dataclass(frozen=True)
class Run:
    """Who runs, and when; one timestamp for everything the run records."""

    at: datetime
    pipeline_uuid: str
    block_uuid: str | None = None
    owner: str | None = None


def asset_row(spark: SparkSession, asset, run: Run, stored_rows: int, batch_rows: int) -> DataFrame:
    """The registry row of a table; the row count is that of the stored table."""
    key = F.lit(asset.key)
    return spark.range(1).select(
        key.alias("asset_key"), schema_of(key).alias("schema_name"), table_of(key).alias("table_name"),
        F.lit(asset.layer).alias("layer"), F.lit(asset.description).alias("description"),
        F.lit(asset.source).alias("source_system"), F.lit(asset.source_detail).alias("source_detail"),
        F.lit(asset.grain).alias("grain"), F.lit(run.owner).cast("string").alias("owner"),
        F.lit(run.pipeline_uuid).cast("string").alias("pipeline_uuid"),
        F.lit(run.block_uuid or asset.key).alias("block_uuid"),
        F.lit(run.at).cast("timestamp").alias("last_run_at"),
        F.lit(stored_rows).cast("bigint").alias("last_row_count"), F.lit(batch_rows).cast("bigint").alias("last_batch_rows"),
    )


def measure_fields(df: DataFrame, asset_key: str, docs=None) -> DataFrame:
    """Per column: type, documentation, rows and filled values; one pass, one row a column."""
    counts = df.agg(F.count("*").alias("rows"), *[F.count(f.name).alias(f"n{i}") for i, f in enumerate(df.schema)])
    found = [
        F.struct(
            F.lit(asset_key).alias("asset_key"), *described,
            (F.col(f"n{i}") < F.col("rows")).alias("is_nullable"), F.col("rows"), F.col(f"n{i}").alias("filled"),
        )
        for i, described in enumerate(_described(df.schema, docs))
    ]
    return counts.select(F.inline(F.array(*found)))


def _described(schema, docs) -> list[list]:
    """Name, type, description and unit of each column."""
    found = []
    for f in schema:
        description, unit = (docs or {}).get(f.name, (None, None))
        found.append([
            F.lit(f.name).alias("field_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(description).cast("string").alias("description"), F.lit(unit).cast("string").alias("unit"),
        ])
    return found


def written_fields(spark: SparkSession, schema, asset_key: str, docs, rows: int, filled: dict[str, int]) -> DataFrame:
    """The rows of `profile_fields` from what the write counted; nothing is read."""
    found = [
        F.struct(F.lit(asset_key).alias("asset_key"), *described, F.lit(filled[f.name] < rows).alias("is_nullable"))
        for f, described in zip(schema, _described(schema, docs))
    ]
    return spark.range(1).select(F.inline(F.array(*found)))


def metric_rows(spark: SparkSession, asset_key: str, metrics) -> DataFrame:
    """(asset_key, metric, value) rows of what a run counted while it wrote."""
    rows = [(asset_key, metric, None if value is None else int(value)) for metric, value in metrics]
    return spark.createDataFrame(rows, "asset_key string, metric string, value bigint")


def profile_fields(df: DataFrame, asset_key: str, docs=None) -> DataFrame:
    """The registry's view of every column, with nullability as observed."""
    return measure_fields(df, asset_key, docs).drop("rows", "filled")


def sketch_rows(spark: SparkSession, asset_key: str, run: Run, sketches) -> DataFrame:
    """(asset_key, column_name, run_at, sketch): what a run's write knows of the distinct values of a column."""
    rows = [(asset_key, column, bytes(sketch)) for column, sketch in sketches.items()]
    found = spark.createDataFrame(rows, "asset_key string, column_name string, sketch binary")
    return found.select("asset_key", "column_name", F.lit(run.at).cast("timestamp").alias("run_at"), "sketch")


def merged_distincts(sketches: DataFrame) -> DataFrame:
    """Distinct values of a column over all runs of a table, about: the sketches are united, no data is read again."""
    return sketches.groupBy("asset_key", "column_name").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values")
    )


def edges_to(spark: SparkSession, asset_key: str, upstreams) -> DataFrame:
    rows = [(up, asset_key, FEEDS) for up in upstreams]
    return spark.createDataFrame(rows, "from_asset string, to_asset string, edge_type string")


def with_docs(df: DataFrame, docs) -> DataFrame:
    """Column descriptions and units carried in the schema, where Parquet keeps them."""
    known = {c: docs[c] for c in df.columns if c in docs}
    for column, (description, unit) in known.items():
        df = df.withMetadata(column, {"comment": description, **({"unit": unit} if unit else {})})
    return df


class Catalog:
    """Collects what a run has to record and merges it into the registry tables at the end."""

    def __init__(self, store: TableStore):
        self.store = store
        self.pending: dict[str, list[DataFrame]] = {t: [] for t in TABLES}

    def add(self, table: str, rows: DataFrame) -> None:
        self.pending[table].append(rows)

    def flush(self, refresh_docs: bool = False) -> None:
        """Merge: known assets, fields and checks are refreshed, known edges left alone."""
        asset_refresh = ("last_run_at", "last_row_count", "last_batch_rows", "pipeline_uuid", "block_uuid")
        field_refresh = ("data_type", "is_nullable") + (("description", "unit") if refresh_docs else ())
        check_refresh = ("passed", "bad", "detail", "checked_at")
        merges = {
            ASSET_TABLE: lambda t, b: self.store.merge_columns(t, b, ("asset_key",), asset_refresh),
            FIELD_TABLE: lambda t, b: self.store.merge_columns(t, b, ("asset_key", "field_name"), field_refresh),
            EDGE_TABLE: lambda t, b: self.store.add_rows(t, b),
            CHECK_TABLE: lambda t, b: self.store.merge_columns(t, b, ("asset_key", "check_name"), check_refresh),
            METRIC_TABLE: lambda t, b: self.store.merge_columns(t, b, ("asset_key", "metric"), ("value",)),
            UNLISTED_TABLE: lambda t, b: self.store.merge_columns(t, b, ("asset_key", "field", "data_type"), ("records",)),
            SKETCH_TABLE: lambda t, b: self.store.merge_columns(t, b, ("asset_key", "column_name", "run_at"), ("sketch",)),
        }
        for table, frames in self.pending.items():
            if frames:
                merges[table](table, reduce(lambda a, b: a.unionByName(b), frames))
                self.pending[table] = []

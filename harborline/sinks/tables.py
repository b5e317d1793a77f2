"""Published tables: Parquet tables of the session's catalog, replaced, reloaded and merged.

The catalog knows a table's columns, partitions and folder; the work here is the joins and key checks of a merge. New
content is written to a folder of its own, checked there, and published by pointing the table at it, so the data is
written once and a crashed job leaves the old content in place. A merge into a partitioned table is Spark's dynamic
partition overwrite: only the partitions of the batch are read and written. A reload is `INSERT OVERWRITE ... BY NAME`,
where Spark holds the batch against the table's columns. Tables outlive the session where its catalog does (a metastore).
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from harborline.operators.upserts import assert_key, insert_ignore, last_wins, partial_upsert, upsert
from harborline.session import hadoop_path, spread, stage


@dataclass(frozen=True)
class Prepared:
    """Content that is written but not published."""

    key: str
    path: str
    schema: T.StructType
    partition_by: tuple[str, ...] = field(default=())


class TableStore:
    """Tables named ``schema.table`` under one root folder. ``namespace`` is put before the names of databases."""

    def __init__(self, spark: SparkSession, root: str, namespace: str = ""):
        self.spark, self.root, self.namespace = spark, root.rstrip("/"), namespace

    # ---- what is there -------------------------------------------------------

    def name(self, key: str) -> str:
        """The name of a table in SQL."""
        schema, table = key.split(".")
        return f"`{self.namespace}{schema}`.`{table}`"

    def path(self, key: str) -> str:
        return f"{self.root}/{key.replace('.', '/')}"

    def exists(self, key: str) -> bool:
        return self.spark.catalog.tableExists(self.name(key))

    def read(self, key: str, partitions: dict[str, list] | None = None) -> DataFrame:
        """Current content; ``partitions`` keeps only the listed partition values."""
        if not self.exists(key):
            raise FileNotFoundError(f"no table {key} in {self.root}")
        df = self.spark.table(self.name(key))
        for column, values in (partitions or {}).items():
            df = df.where(F.col(column).isin(values))
        return df

    def location(self, key: str) -> str:
        """The folder the table points at."""
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(key)}").where("col_name = 'Location'").collect()
        return rows[-1]["data_type"]

    # ---- writes --------------------------------------------------------------

    def prepare(self, key: str, df: DataFrame, partition_by=(), sort_by=(), figures=None, layout=None) -> Prepared:
        """Write new content next to the current one, not visible yet.

        ``figures`` are taken by the write. ``layout`` (see `sinks/layout.py`) lays rows out by range; ``sort_by`` orders
        the rows of each file only.
        """
        path = f"{self.path(key)}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        laid_out = layout.laid_out(df) if layout else spread(df, partition_by)
        if sort_by and not layout:
            laid_out = laid_out.sortWithinPartitions(*sort_by)
        if figures:
            laid_out = figures.on(laid_out)
        writer = laid_out.write.partitionBy(*partition_by)
        for option, value in (layout.options() if layout else {}).items():
            writer = writer.option(option, value)
        writer.parquet(path)
        return Prepared(key, path, df.schema, tuple(partition_by))

    def prepared(self, content: Prepared) -> DataFrame:
        return self.spark.read.schema(content.schema).parquet(content.path).select(*content.schema.names)

    def publish(self, content: Prepared) -> None:
        """Make prepared content the current one: the table points at its folder from now on."""
        name = self.name(content.key)
        if self.exists(content.key):
            if not content.partition_by and self._same_columns(content):
                self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{content.path}'")
                self.spark.catalog.refreshTable(name)
                return
            # Other columns or partitions are another definition. The table owns no files: the old ones stay.
            self.spark.sql(f"DROP TABLE {name}")
        database = name.split(".")[0]
        folder = self.path(content.key).rsplit("/", 1)[0]
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}'")
        if not content.partition_by:
            self.spark.catalog.createTable(name, path=content.path, source="parquet", schema=content.schema)
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in content.schema)
        keys = ", ".join(f"`{c}`" for c in content.partition_by)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({keys}) LOCATION '{content.path}'")
        self.spark.catalog.recoverPartitions(name)

    def _same_columns(self, content: Prepared) -> bool:
        current = self.read(content.key).schema
        partitioned = any(c.isPartition for c in self.spark.catalog.listColumns(self.name(content.key)))
        return not partitioned and current.jsonValue() == T.StructType(
            [T.StructField(f.name, f.dataType, True, f.metadata) for f in content.schema]
        ).jsonValue()

    def replace(self, key: str, df: DataFrame, partition_by=()) -> DataFrame:
        """Whole new content, with whatever columns the frame has."""
        self.publish(self.prepare(key, df, partition_by))
        return self.read(key)

    def reload(self, key: str, df: DataFrame, partition_by=()) -> DataFrame:
        """Whole new content under the columns the table has: a missing or other column, or another type, is an error.

        The frame must not read the table itself.
        """
        if not self.exists(key):
            return self.replace(key, df, partition_by)
        current = self.read(key)
        types = {f.name: f.dataType for f in current.schema}
        odd = [f"{f.name} {f.dataType.simpleString()}" for f in df.schema if types.get(f.name, f.dataType) != f.dataType]
        if odd:
            # Spark would store them after a cast that it takes for safe.
            raise ValueError(f"{key} has other types than the batch: {', '.join(odd)}")
        if partition_by:
            # A dynamic overwrite leaves partitions that the batch lacks alone; a reload clears them.
            return self.replace(key, df.select(*current.columns), partition_by)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name(key)} BY NAME SELECT * FROM {{batch}}", batch=df)
        return self.read(key)

    def upsert(
        self, key: str, batch: DataFrame, keys, partition_by: str | None = None, position=(), staged: bool = False
    ) -> DataFrame:
        """Merge a batch by key: known keys are replaced, other rows stay.

        With ``position`` columns a repeated key is allowed and its last row wins; without,
        it is an error, as is an incomplete key. Of a partitioned table only the partitions
        the batch touches are read and overwritten. ``staged`` says the batch is a written table.
        """
        if partition_by and partition_by not in keys:
            raise ValueError(f"{key}: the partition column {partition_by} must be part of the key")
        if position:
            batch = last_wins(batch, keys, position)
        if position or not staged:
            batch = stage(batch, "batch")
        assert_key(batch, keys, f"batch for {key}")
        if not self.exists(key):
            return self.replace(key, batch, (partition_by,) if partition_by else ())
        if not partition_by:
            return self.replace(key, upsert(self.read(key), batch, keys))
        # One value per partition folder: as many as the table has folders, not rows.
        touched = [r[0] for r in batch.select(partition_by).distinct().collect()]
        if touched:
            merged = upsert(self.read(key, {partition_by: touched}), batch, keys)
            self.spark.sql(
                f"INSERT OVERWRITE TABLE {self.name(key)} BY NAME SELECT * FROM {{merged}}",
                merged=spread(merged, (partition_by,)),
            )
        return self.read(key)

    def merge_columns(self, key: str, batch: DataFrame, keys, refresh) -> DataFrame:
        """Insert new keys; refresh only the listed columns of known ones. A batch must not repeat a key."""
        assert_key(batch, keys, f"batch for {key}")
        if not self.exists(key):
            return self.replace(key, batch)
        return self.replace(key, partial_upsert(self.read(key), batch, keys, refresh))

    def add_rows(self, key: str, batch: DataFrame) -> DataFrame:
        """Add rows that are not there yet."""
        if not self.exists(key):
            return self.replace(key, batch.distinct())
        return self.replace(key, insert_ignore(self.read(key), batch))

    def vacuum(self, key: str) -> int:
        """Delete content older than the current one, which no new reader needs; returns how many folders."""
        current = self.location(key).rsplit("/", 1)[1]
        folder, files = hadoop_path(self.spark, self.path(key))
        old = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName() < current]
        for path in old:
            files.delete(path, True)
        return len(old)

"""Where rows lie in a published table, so that a lookup opens few files.

Parquet has no secondary indexes. What stands in for them: rows are dealt to files by ranges of the lookup columns, so
that the smallest and largest value a file states leave most files out, and a Bloom filter for each column that is looked
up by value lets a reader skip row groups whose range holds the value by chance.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Layout:
    """Rows by ranges of ``by``; Bloom filters on ``lookups``, with about ``distinct`` values of each in a row group."""

    by: tuple[str, ...]
    lookups: tuple[str, ...] = ()
    distinct: int = 100_000
    # Without a number, the width of shuffles; partitions that turn out small are put together at run time.
    files: int | None = None

    def laid_out(self, df: DataFrame) -> DataFrame:
        columns = [F.col(c) for c in self.by]
        ranged = df.repartitionByRange(self.files, *columns) if self.files else df.repartitionByRange(*columns)
        return ranged.sortWithinPartitions(*columns)

    def options(self) -> dict[str, str]:
        found = {}
        for column in self.lookups:
            found[f"parquet.bloom.filter.enabled#{column}"] = "true"
            found[f"parquet.bloom.filter.expected.ndv#{column}"] = str(self.distinct)
        return found

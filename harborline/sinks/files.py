"""Plain file output."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header line, one file per task; ``single_file`` is for small results only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").csv(path)

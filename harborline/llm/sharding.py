"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to `BITS` bits: a size by its logarithm, a name by its hash. The cell of a document gets its
index on a Hilbert curve, documents are put in order of that index, and the order is cut into runs of equal numbers of
rows (law `rows`: two shards differ by one row at most). Neighbours on the curve are neighbours in every dimension, so
each shard, and each row group in it, covers few cells of every dimension, and `manifest` says which; a reader that
knows the wanted cell skips the rest.

The order comes from a range shuffle on (curve index, text hash, doc_id): a cell that holds a third of all documents is
spread over many tasks. Rows are numbered inside the sorted and written partitions, and one count for each partition
shifts the numbers; no task sees more than its range. A task run again reads the written table, so numbers stand.

Defined results: a null text counts as empty; null metadata hash like the empty name; equal texts of one cell are
neighbours; rows that tie in all of index, text and doc_id are repeated rows and take any order among themselves; with
fewer rows than shards some shards are empty; an empty table gives an empty result. Other columns are carried along;
columns called shard, slot or curve are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from harborline.llm.common import stage, whole_text

BITS = 5


def hilbert_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of rows of cell numbers, one column for each dimension.

    Gray code undone bit by bit, then the bits of all dimensions interleaved (the transpose form of the curve).
    """
    x = [np.array(c, np.int64) for c in np.asarray(cells).T]
    dims, bit = len(x), 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for d in range(dims):
            turn = (x[d] & bit) != 0
            swap = np.where(turn, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(turn, x[0] ^ low, x[0] ^ swap)
            x[d] = x[d] ^ swap
        bit >>= 1
    for d in range(1, dims):
        x[d] = x[d] ^ x[d - 1]
    flip, bit = np.zeros_like(x[0]), 1 << (bits - 1)
    while bit > 1:
        flip = np.where((x[-1] & bit) != 0, flip ^ (bit - 1), flip)
        bit >>= 1
    index = np.zeros_like(x[0])
    for b in reversed(range(bits)):
        for d in range(dims):
            index = (index << 1) | (((x[d] ^ flip) >> b) & 1)
    return index


def name_cell(name: str) -> Column:
    """A name's cell, by its hash."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(name).cast("string"), F.lit(""))), F.lit(1 << BITS)).cast("int")


def size_cell(size: Column) -> Column:
    """A size's cell: a quarter of a doubling wide at first, at least two cells for each doubling of sizes."""
    return F.least(F.lit((1 << BITS) - 1), F.floor(F.log2(size + F.lit(1)) * F.lit(2)) - F.lit(8)).cast("int")


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text and one."""
    return (F.octet_length(whole_text(text)) + 1).cast("bigint")


def dimensions() -> dict[str, Column]:
    """The cells documents are laid out by."""
    return {
        "source": name_cell("source"),
        "lang": name_cell("lang"),
        "size": F.greatest(F.lit(0), size_cell(text_size())),
    }


def shard(docs: DataFrame, shards: int, dims: dict[str, Column] | None = None) -> DataFrame:
    """The documents with shard, slot (from 0 without gaps), curve (the index) and cells (one number a dimension)."""
    dims = dims or dimensions()
    spark = docs.sparkSession

    @F.pandas_udf("bigint")
    def index(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(cells.to_numpy()))

    plain = docs.drop("shard", "slot", "curve", "cells")
    keyed = plain.withColumn("cells", F.struct(*[c.alias(n) for n, c in dims.items()]))
    keyed = keyed.withColumn("curve", index("cells")).withColumn("_harborline_tie", F.xxhash64(whole_text()))
    order = ("curve", "_harborline_tie", "doc_id")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = keyed.repartitionByRange(width, *order).sortWithinPartitions(*order).drop("_harborline_tie")
    # The row number inside a partition stands in the lower 33 bits.
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    laid = stage(laid.withColumns({"_harborline_part": F.spark_partition_id(), "_harborline_at": at}), "curve")
    sizes = sorted((r["_harborline_part"], r["n"]) for r in laid.groupBy("_harborline_part").agg(F.count("*").alias("n")).collect())
    starts = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    total = starts[-1]
    # One row for each written partition.
    offsets = spark.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts)], "_harborline_part int, _harborline_start bigint")
    rank = F.col("_harborline_start") + F.col("_harborline_at")
    which = F.expr(f"int((_harborline_start + _harborline_at) * {shards}L div {max(total, 1)}L)")
    placed = laid.join(F.broadcast(offsets), "_harborline_part").withColumn("shard", which)
    first = F.expr(f"(bigint(shard) * {total}L + {shards - 1}L) div {shards}L")
    return placed.withColumn("slot", rank - first).drop("_harborline_part", "_harborline_at", "_harborline_start")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, rows in the order of the curve."""
    sharded.write.partitionBy("shard").parquet(path)


def manifest(sharded: DataFrame) -> DataFrame:
    """The lowest and highest cell of each dimension in each shard, and its rows."""
    cells = sharded.schema["cells"].dataType.names
    ends = [f(F.col("cells")[c]).alias(f"{c}_{n}") for c in cells for n, f in (("low", F.min), ("high", F.max))]
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), *ends)

"""Ranks that stay distributed when one group, or the whole table, is large."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from harborline.session import stage

# A BIGINT is read as three digits of 22, 21 and 21 bits, which bounds every
# window below by 2**22 rows whatever the values are.
DIGIT_BITS = 21

# monotonically_increasing_id() holds the row's place in its partition in the lower bits.
PLACE_BITS = 33


def rank_within(df: DataFrame, by: str, value: str, tiebreak: str, out: str) -> DataFrame:
    """Row number within ``by``, largest value first, NULL values last, ties by ``tiebreak``.

    Rows are range-partitioned and sorted by group and order, so a hot group spans many
    slices and no task holds more than a slice. A row's place in its slice, less the place
    where its group begins there, plus the rows the group has in earlier slices, is its
    number. Places are written before use: a recomputed partition cannot change them.
    """
    order = [F.col(by), F.col(value).desc_nulls_last(), F.col(tiebreak).asc()]
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    ranged = df.repartitionByRange(width, *order).sortWithinPartitions(*order)
    rows = stage(ranged.withColumns({"_slice": F.spark_partition_id(), "_place": place}), f"slices-{out}")
    parts = rows.groupBy(F.col(by).alias("_by"), F.col("_slice").alias("_in")).agg(
        F.count("*").alias("_n"), F.min("_place").alias("_begins")
    )
    earlier = Window.partitionBy("_by").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_begins") + 1
    shifts = parts.select("_by", "_in", shift.alias("_shift"))
    joined = rows.join(shifts, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_slice") == F.col("_in")))
    return joined.select(*df.columns, (F.col("_place") + F.col("_shift")).cast("bigint").alias(out))


def rank_min_desc(df: DataFrame, value: str, out: str) -> DataFrame:
    """Competition rank over the whole table, largest first; ties share the smallest rank.

    A missing value has no rank. The rank of a value is one plus the number of rows above
    it, found digit by digit on a histogram: rows under a larger leading digit, then under
    the same leading digit and a larger second one, then a larger third. No window ever
    sees the rows themselves, and none is larger than one digit allows.
    """
    if df.schema[value].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{value} must hold whole numbers")
    number = F.col(value).cast("bigint")
    # Never NULL, and declared so: the three uses below then share one shuffle.
    known = F.coalesce(number, F.lit(0).cast("bigint"))
    histogram = (
        df.where(F.col(value).isNotNull())
        .groupBy(known.alias("_value")).agg(F.count("*").alias("_n"))
        .withColumn("_middle", F.shiftright("_value", DIGIT_BITS))
        .withColumn("_top", F.shiftright("_value", 2 * DIGIT_BITS))
    )
    middles = histogram.groupBy("_top", "_middle").agg(F.sum("_n").alias("_n"))
    tops = middles.groupBy("_top").agg(F.sum("_n").alias("_n"))

    def above(window):
        return F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    tops = tops.select("_top", above(Window.orderBy(F.desc("_top"))).alias("_above_top"))
    middles = middles.withColumn("_above_middle", above(Window.partitionBy("_top").orderBy(F.desc("_middle"))))
    offsets = middles.join(tops, "_top").select("_middle", (F.col("_above_top") + F.col("_above_middle")).alias("_above"))
    ranks = (
        histogram.withColumn("_above_value", above(Window.partitionBy("_middle").orderBy(F.desc("_value"))))
        .join(offsets, "_middle")
        .select("_value", (F.col("_above") + F.col("_above_value") + 1).cast("bigint").alias(out))
    )
    return df.join(ranks, number == F.col("_value"), "left").drop("_value")

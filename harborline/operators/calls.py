"""Vessel calls per port: daily to monthly, and the published monthly mart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from harborline.functions.columns import first_of_month
from harborline.sources.schemas import VESSEL_TYPES

CALL_KEYS = ("portid", "calls_year", "calls_month")
CALL_COUNTS = tuple(f"calls_{t}" for t in (*VESSEL_TYPES, "total"))


def roll_up_months(daily: DataFrame, types=VESSEL_TYPES) -> DataFrame:
    """Sum of calls per port and month, by vessel type and in total.

    Sums are combined before the shuffle, so a port with very many days costs its
    tasks a few rows each.
    """
    sums = [F.sum(f"portcalls_{t}").cast("bigint").alias(f"calls_{t}") for t in types]
    return daily.groupBy(
        "portid", F.col("year").cast("int").alias("calls_year"), F.col("month").cast("int").alias("calls_month")
    ).agg(*sums, F.sum("portcalls").cast("bigint").alias("calls_total"))


def max_year(df: DataFrame, year: str = "year") -> DataFrame:
    return df.agg(F.max(year).alias("max_year"))


def latest_years(df: DataFrame, year: str, last_n_years: int = 2) -> DataFrame:
    """Rows of the newest year and the ones just before it.

    The bound is a scalar subquery over the year column alone; on a table partitioned
    by year it prunes partitions at run time.
    """
    newest: Column = max_year(df, year).scalar()
    return df.where(F.col(year) >= newest - (last_n_years - 1))


def concat_years(frames) -> DataFrame:
    """Rows of all frames, matched by column name; a column absent from one is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def port_calls_mart(calls: DataFrame, ports: DataFrame) -> DataFrame:
    """Monthly calls with the port's name and place, and the month as a date."""
    named = ports.select("portid", "portname", "country", "country_iso3", "continent")
    return calls.join(named, "portid").select(
        *named.columns, "calls_year", "calls_month",
        first_of_month(F.col("calls_year"), F.col("calls_month")).alias("month_start"),
        *CALL_COUNTS,
    )


def calls_without_port(calls: DataFrame, ports: DataFrame) -> DataFrame:
    """Monthly calls whose port is not in the port table."""
    return calls.join(ports.select("portid"), "portid", "left_anti")

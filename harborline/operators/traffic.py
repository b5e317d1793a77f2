"""Country reference, yearly container traffic, and what is derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from harborline.functions.columns import (
    equals_or_false,
    exact_sum,
    growth_rate,
    lenient_double,
    rounded_mean,
    strict_int,
    whole_number,
)
from harborline.operators.ranking import rank_min_desc
from harborline.session import stage

# The growth window of the published summary, and the region name
# that marks an entity as a grouping of countries.
BASE_YEAR = 2010
COMPARE_YEAR = 2019
AGGREGATE_REGION = "Aggregates"

COUNTRY_ATTRIBUTES = ("country_name", "region_code", "region_name", "longitude", "latitude")


def country_dim(records: DataFrame) -> DataFrame:
    """Country records to the reference table, with numeric coordinates and the grouping flag."""
    return records.select(
        F.col("id").alias("country_iso3"),
        F.col("iso2Code").alias("country_iso2"),
        F.col("name").alias("country_name"),
        F.col("region.id").alias("region_code"),
        F.col("region.value").alias("region_name"),
        F.col("capitalCity").alias("capital_city"),
        lenient_double(F.col("longitude")).alias("longitude"),
        lenient_double(F.col("latitude")).alias("latitude"),
        equals_or_false(F.col("region.value"), AGGREGATE_REGION).alias("is_aggregate"),
    )


def country_dim_stats(countries: DataFrame) -> DataFrame:
    """Entities, and how many of them are groupings."""
    return countries.agg(F.count("*").alias("rows"), F.count_if("is_aggregate").alias("aggregates"))


def _reported(records: DataFrame) -> DataFrame:
    return records.where(F.col("value").isNotNull()).select(
        F.col("countryiso3code").alias("country_iso3"),
        F.col("country.id").alias("country_id"),
        F.col("country.value").alias("country_name"),
        strict_int(F.col("date")).alias("traffic_year"),
        whole_number(F.col("value")).alias("teu"),
    )


def _real_countries(countries: DataFrame) -> DataFrame:
    return countries.where(~F.col("is_aggregate")).select("country_iso3")


def clean_traffic(records: DataFrame, countries: DataFrame) -> DataFrame:
    """Indicator records to typed traffic of real countries: reported values only."""
    return _reported(records).join(_real_countries(countries), "country_iso3", "left_semi")


def clean_traffic_stats(records: DataFrame, countries: DataFrame) -> DataFrame:
    """Row counts in, after each filter, and the span of what is left; one pass over the records."""
    real = _real_countries(countries).distinct().withColumn("is_real", F.lit(True))
    flagged = records.select(F.col("countryiso3code").alias("country_iso3"), "date", "value").join(
        real, "country_iso3", "left"
    )
    reported = F.col("value").isNotNull()
    kept = reported & F.coalesce("is_real", F.lit(False))
    year = F.when(kept, strict_int(F.col("date")))
    return flagged.agg(
        F.count("*").alias("rows_in"),
        F.count_if(reported).alias("after_nulls"),
        F.count_if(kept).alias("after_aggregates"),
        F.count_distinct(F.when(kept, F.col("country_iso3"))).alias("countries"),
        F.min(year).alias("min_year"),
        F.max(year).alias("max_year"),
    )


def enrich_traffic(traffic: DataFrame, countries: DataFrame) -> DataFrame:
    """Traffic of real countries with the attributes of the country."""
    attributes = countries.where(~F.col("is_aggregate")).select(
        "country_iso3", "region_code", "region_name", "longitude", "latitude"
    )
    return traffic.select("country_iso3", "country_name", "traffic_year", "teu").join(attributes, "country_iso3")


def region_totals(traffic: DataFrame, countries: DataFrame, ordered: bool = False) -> DataFrame:
    """Total, number of rows and rounded mean per region and year.

    ``ordered`` sorts by region name and year for reading; a table write has no use for it.
    """
    joined = traffic.select("country_iso3", "traffic_year", "teu").join(
        countries.where(~F.col("is_aggregate")).select("country_iso3", "region_code", "region_name"), "country_iso3"
    )
    sums = joined.groupBy("region_code", "region_name", "traffic_year").agg(
        exact_sum(F.col("teu")).alias("total"), F.count("*").alias("countries_reporting"),
        F.count("teu").alias("values"),
    )
    totals = sums.select(
        "region_code", "region_name", "traffic_year",
        F.col("total").cast("bigint").alias("total_teu"),
        "countries_reporting",
        rounded_mean(F.col("total"), F.col("values")).alias("mean_teu"),
    )
    return totals.orderBy(F.col("region_name").asc_nulls_last(), "traffic_year") if ordered else totals


def country_summary(traffic: DataFrame, base_year: int = BASE_YEAR, compare_year: int = COMPARE_YEAR) -> DataFrame:
    """One row per country: latest figure, two chosen years, growth between them, rank.

    Takes the result of ``enrich_traffic``. The heavy pass groups by the country with
    its attributes as keys, so that the buffers hold only numbers and the work is a
    hash aggregation with map-side combining; no row is sorted and no side is joined.
    A second, tiny aggregation settles countries whose attributes changed over time
    in favour of the latest year.
    """
    base, compare = f"teu_{base_year}", f"teu_{compare_year}"
    # Orders by (year, teu): a year outweighs any BIGINT, so ties do not depend on arrival.
    age = F.col("traffic_year").cast("decimal(10,0)") * F.lit("1" + "0" * 20).cast("decimal(21,0)") + F.coalesce(
        F.col("teu").cast("decimal(20,0)"), -F.lit("1" + "0" * 19).cast("decimal(20,0)")
    )
    per_spelling = traffic.groupBy("country_iso3", *COUNTRY_ATTRIBUTES).agg(
        F.max("traffic_year").alias("latest_year"),
        F.max_by("teu", age).alias("latest_teu"),
        F.max(F.when(F.col("traffic_year") == compare_year, F.col("teu"))).alias(compare),
        F.max(F.when(F.col("traffic_year") == base_year, F.col("teu"))).alias(base),
    )
    newest = F.max(F.struct("latest_year", "latest_teu", *COUNTRY_ATTRIBUTES))
    per_country = per_spelling.groupBy("country_iso3").agg(
        newest.alias("newest"), F.max(compare).alias(compare), F.max(base).alias(base)
    )
    summary = per_country.select(
        "country_iso3",
        *[F.col(f"newest.{c}").alias(c) for c in (*COUNTRY_ATTRIBUTES, "latest_year", "latest_teu")],
        compare,
        base,
        growth_rate(F.col(compare), F.col(base), compare_year - base_year).alias(f"cagr_{base_year}_{compare_year}"),
    )
    # One row per country from here on; the rank reads it more than once.
    return rank_min_desc(stage(summary, "country-summary"), compare, f"rank_{compare_year}")


def country_summary_stats(
    summary: DataFrame, base_year: int = BASE_YEAR, compare_year: int = COMPARE_YEAR
) -> DataFrame:
    """Countries, those with the compared figure, those with growth, and those whose growth is undefined."""
    base, compare = F.col(f"teu_{base_year}"), F.col(f"teu_{compare_year}")
    growth = F.col(f"cagr_{base_year}_{compare_year}")
    return summary.agg(
        F.count("*").alias("countries"),
        F.count(compare).alias("with_figure"),
        F.count(growth).alias("with_growth"),
        F.count_if(base.isNotNull() & compare.isNotNull() & growth.isNull()).alias("growth_undefined"),
    )

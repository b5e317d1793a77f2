"""Every registered query against its SQL, on the smallest tables, at two shuffle widths."""

import pytest

import __spark_entry__ as entry
import check

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SMALL)


@pytest.mark.parametrize("key", list(entry.QUERIES))
def test_matches_sql(spark, con, key):
    same, got, want, _, have, names = check.compare(spark, con, key, SMALL)
    assert same, f"{got} rows of {sorted(have)} against {want} of {sorted(names)}"


@pytest.mark.parametrize("key", ["region_totals", "country_summary", "rank_hot_groups", "mart_connections", "upsert_last_wins"])
def test_shuffle_width_changes_nothing(spark, rows, key):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    query = entry.queries()[key]
    narrow = rows(query(spark, SMALL))
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert rows(query(spark, SMALL)) == narrow
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_every_query_has_sql():
    assert set(entry.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "region_code", "region_name", "traffic_year", "total_teu", "countries_reporting", "mean_teu",
    ]

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from harborline.operators import calls, connections, traffic

RECORDS = "country struct<id: string, value: string>, countryiso3code string, date string, value double"
COUNTRIES = (
    "id string, iso2Code string, name string, region struct<id: string, value: string>, "
    "capitalCity string, longitude string, latitude string"
)


@pytest.fixture(scope="module")
def countries(spark):
    rows = [
        ("AAA", "AA", "Aland", ("R1", "North"), "Acity", "10.5", "1e1"),
        ("BBB", "BB", "Bland", ("R1", "North"), "", "", "abc"),
        ("CCC", "CC", "Cland", ("R2", None), "Ccity", "1.0d", " 12 "),
        ("WLD", "1W", "World", ("NA", "Aggregates"), "", "", ""),
    ]
    return traffic.country_dim(spark.createDataFrame(rows, COUNTRIES))


def records(spark, rows):
    return spark.createDataFrame([((c[:2], c.title()), c, y, v) for c, y, v in rows], RECORDS)


def test_country_dim(countries, rows):
    assert countries.columns == [
        "country_iso3", "country_iso2", "country_name", "region_code", "region_name",
        "capital_city", "longitude", "latitude", "is_aggregate",
    ]
    assert rows(countries.select("country_iso3", "longitude", "latitude", "is_aggregate")) == [
        ("AAA", 10.5, 10.0, False), ("BBB", None, None, False), ("CCC", None, 12.0, False), ("WLD", None, None, True),
    ]


def test_clean_traffic(spark, countries, rows):
    raw = records(spark, [
        ("AAA", "2019", 10.9), ("AAA", "x", None), ("WLD", "2019", 99.0), ("ZZZ", "2019", 1.0), (None or "CCC", "2010", 5.0),
    ])
    assert rows(traffic.clean_traffic(raw, countries)) == [("AAA", "AA", "Aaa", 2019, 10), ("CCC", "CC", "Ccc", 2010, 5)]
    assert tuple(traffic.clean_traffic_stats(raw, countries).first()) == (5, 4, 2, 2, 2010, 2019)


def test_bad_year_of_a_reported_value_stops_the_job(spark, countries):
    with pytest.raises(PySparkException):
        traffic.clean_traffic(records(spark, [("AAA", "x", 1.0)]), countries).collect()


def test_stats_of_nothing(spark, countries):
    assert tuple(traffic.clean_traffic_stats(records(spark, []), countries).first()) == (0, 0, 0, 0, None, None)


def test_region_totals(spark, countries, rows):
    t = spark.createDataFrame(
        [("AAA", "A", 2019, 1), ("BBB", "B", 2019, 2), ("CCC", "C", 2019, 7), ("WLD", "W", 2019, 9)],
        "country_iso3 string, country_name string, traffic_year int, teu bigint",
    )
    assert rows(traffic.region_totals(t, countries)) == [("R1", "North", 2019, 3, 2, 2), ("R2", None, 2019, 7, 1, 7)]


def test_region_totals_in_reading_order(spark, countries):
    t = spark.createDataFrame(
        [("CCC", "C", 2019, 7), ("AAA", "A", 2019, 1), ("AAA", "A", 2010, 1)],
        "country_iso3 string, country_name string, traffic_year int, teu bigint",
    )
    got = traffic.region_totals(t, countries, ordered=True).collect()
    assert [(r["region_name"], r["traffic_year"]) for r in got] == [("North", 2010), ("North", 2019), (None, 2019)]


def test_counts_for_the_log(spark, countries):
    assert tuple(traffic.country_dim_stats(countries).first()) == (4, 1)
    rows = [("AAA", 2010, 0), ("AAA", 2019, 250), ("BBB", 2019, 1), ("CCC", 2010, 5), ("CCC", 2019, 6)]
    assert tuple(traffic.country_summary_stats(traffic.country_summary(enriched(spark, rows))).first()) == (3, 3, 1, 1)


def enriched(spark, rows):
    ddl = "country_iso3 string, country_name string, traffic_year int, teu bigint, region_code string, region_name string, longitude double, latitude double"
    return spark.createDataFrame([(c, f"name {c}", y, v, "R", "Region", 1.0, 2.0) for c, y, v in rows], ddl)


def by_pandas(rows):
    """The same summary written with the merges and ranks of pandas."""
    df = pd.DataFrame(rows, columns=["c", "y", "v"])
    out = df.sort_values("y").groupby("c").tail(1).set_index("c").rename(columns={"y": "latest_year", "v": "latest_teu"})
    for year in (2019, 2010):
        out[f"teu_{year}"] = df[df.y == year].set_index("c").v
    out["cagr"] = ((out.teu_2019 / out.teu_2010) ** (1 / 9) - 1).round(4)
    out["rank"] = out.teu_2019.rank(ascending=False, method="min")
    return {
        c: tuple(None if pd.isna(v) else v for v in (r.latest_year, r.latest_teu, r.teu_2019, r.teu_2010, r.cagr, r["rank"]))
        for c, r in out.iterrows()
    }


def test_country_summary_like_pandas(spark):
    rows = [
        ("AAA", 2010, 100), ("AAA", 2019, 250), ("AAA", 2021, 300), ("BBB", 2019, 250), ("BBB", 2010, 300),
        ("CCC", 2010, 50), ("DDD", 2019, 900), ("EEE", 2019, 10), ("EEE", 2010, 70), ("EEE", 2018, 20),
    ]
    got = traffic.country_summary(enriched(spark, rows))
    assert got.columns == [
        "country_iso3", "country_name", "region_code", "region_name", "longitude", "latitude",
        "latest_year", "latest_teu", "teu_2019", "teu_2010", "cagr_2010_2019", "rank_2019",
    ]
    assert {r[0]: tuple(r)[6:] for r in got.collect()} == by_pandas(rows)


def test_country_summary_is_one_row_per_country(spark):
    df = enriched(spark, [("AAA", 2019, 5), ("AAA", 2019, 8), ("AAA", 2019, 8)])
    moved = enriched(spark, [("AAA", 2020, None)]).withColumn("country_name", F.lit("renamed"))
    got = traffic.country_summary(df.union(moved)).collect()
    assert len(got) == 1
    assert (got[0].country_name, got[0].latest_year, got[0].latest_teu, got[0].teu_2019, got[0].rank_2019) == ("renamed", 2020, None, 8, 1)


def test_country_summary_needs_no_sort_of_the_rows(spark, folder):
    enriched(spark, [("AAA", 2019, 5)]).write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    seen = []
    original = traffic.stage
    traffic.stage = lambda frame, name: seen.append(frame) or original(frame, name)
    try:
        traffic.country_summary(df)
    finally:
        traffic.stage = original
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("FileScan") == 1
    below = plan[plan.rindex("Exchange"):]
    assert "HashAggregate" in below and "SortAggregate" not in below


def test_empty_summary(spark):
    assert traffic.country_summary(enriched(spark, [])).count() == 0


DAILY = "portid string, year int, month int, " + ", ".join(
    f"portcalls_{t} int" for t in ("container", "dry_bulk", "general_cargo", "roro", "tanker")
) + ", portcalls int"


def test_monthly_calls(spark, rows):
    daily = spark.createDataFrame(
        [("p", 2021, 1, 1, 0, 0, 0, 2, 3), ("p", 2021, 1, 1, 1, None, 0, 0, 2), ("p", 2019, 1, 9, 9, 9, 9, 9, 45), ("q", 2020, 12, 0, 0, 0, 1, 0, 1)],
        DAILY,
    )
    got = calls.roll_up_months(calls.latest_years(daily, "year"))
    assert got.columns == [*calls.CALL_KEYS, *calls.CALL_COUNTS]
    assert rows(got) == [("p", 2021, 1, 2, 1, 0, 0, 2, 5), ("q", 2020, 12, 0, 0, 0, 1, 0, 1)]


def test_latest_years_prunes_partitions(spark, folder):
    spark.createDataFrame([("p", y) for y in (2019, 2020, 2021)], "portid string, year int").write.partitionBy("year").parquet(f"{folder}/d")
    df = spark.read.parquet(f"{folder}/d")
    recent = calls.latest_years(df, "year")
    assert sorted(r["year"] for r in recent.collect()) == [2020, 2021]
    filters = recent._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "year#" in filters


def test_concat_years_aligns_by_name(spark, rows):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2, 0.5)], "s string, n int, extra double")
    got = calls.concat_years([a, b])
    assert got.columns == ["n", "s", "extra"] and rows(got) == [(1, "x", None), (2, "y", 0.5)]


def test_calls_mart_and_orphans(spark, rows):
    ddl = ", ".join(["portid string", "calls_year int", "calls_month int", *[f"{c} bigint" for c in calls.CALL_COUNTS]])
    monthly = spark.createDataFrame([("p", 2021, 3, 1, 2, 3, 4, 5, 15), ("x", 2021, 3, 0, 0, 0, 0, 0, 0)], ddl)
    ports = spark.createDataFrame([("p", "Port", "Land", "LND", "Cont")], "portid string, portname string, country string, country_iso3 string, continent string")
    mart = calls.port_calls_mart(monthly, ports)
    assert [str(r["month_start"]) for r in mart.collect()] == ["2021-03-01"]
    assert rows(calls.calls_without_port(monthly, ports).select("portid")) == [("x",)]


PAIRS = (
    "from_portid string, from_portname string, from_country string, from_iso3 string, to_portid string, to_portname string, "
    "to_country string, to_iso3 string, average_transit_days double, daily_capacity_at_risk double, relative_capacity_at_risk double"
)


def test_connection_mart(spark, rows):
    def pair(a, b, near, far, capacity):
        return (a, a, near, near, b, b, far, far, 1.0, capacity, 0.1)

    df = spark.createDataFrame(
        [pair("a", "b", "X", "X", 5.0), pair("a", "c", "X", None, None), pair("a", "d", "X", "Y", 9.0), pair("e", "b", None, "X", 5.0)], PAIRS
    )
    ports = spark.createDataFrame([("b", "Europe")], "portid string, continent string")
    got = connections.connection_mart(df, ports)
    assert rows(got.select("from_portid", "to_portid", "to_continent", "is_domestic", "rank_from_port", "rank_to_port")) == [
        ("a", "b", "Europe", True, 2, 1), ("a", "c", None, None, 3, 1), ("a", "d", None, False, 1, 1), ("e", "b", "Europe", None, 1, 2),
    ]
    assert len(got.columns) == 15

"""Landed pages to published tables and registry, on files written here."""

import json
import pathlib
from dataclasses import replace
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from harborline.operators import quality as q
from harborline.operators.upserts import KeyViolation
from harborline.plans import assets as a, catalog
from harborline.plans.marts import MartText
from harborline.plans.jobs import QualityFailure, in_order, landed_inputs, run_jobs

FIRST = catalog.Run(at=datetime(2024, 1, 1, tzinfo=timezone.utc), pipeline_uuid="first", owner="ops")
SECOND = catalog.Run(at=datetime(2024, 2, 1, tzinfo=timezone.utc), pipeline_uuid="second")


def page(folder, name, number, body):
    path = pathlib.Path(folder, name)
    path.mkdir(parents=True, exist_ok=True)
    (path / f"page-{number:04d}.json").write_text(json.dumps(body))


def features(rows, more=False):
    return {"features": [{"attributes": r} for r in rows], "exceededTransferLimit": more}


def country(code, region, name):
    return {
        "id": code, "iso2Code": code[:2], "name": name, "region": {"id": region[:2], "value": region},
        "capitalCity": "", "longitude": "1.5", "latitude": "",
    }


def traffic(code, year, value):
    return {"country": {"id": code[:2], "value": code}, "countryiso3code": code, "date": year, "value": value}


def port(portid, **other):
    return {
        "portid": portid, "portname": f"Port {portid}", "country": "Aland", "ISO3": "AAA", "continent": "Europe",
        "lat": 1.0, "lon": 2.0, "LOCODE": None, "vessel_count_total": 7, "fullname": "dropped", **other,
    }


def leg(a_id, b_id, capacity, days=2.0):
    return {
        "from_portid": a_id, "from_portname": a_id, "from_country": "Aland", "from_iso3": "AAA",
        "to_portid": b_id, "to_portname": b_id, "to_country": "Bland", "to_iso3": "BBB",
        "average_transit_days": days, "daily_capacity_at_risk": capacity, "relative_capacity_at_risk": 0.5,
    }


def land(spark, folder, legs=None):
    meta = {"page": 1, "pages": 1}
    page(folder, "countries", 1, [meta, [country("AAA", "North", "Aland"), country("BBB", "North", "Bland"), country("WLD", "Aggregates", "World")]])
    page(folder, "traffic", 1, [{"page": 1, "pages": 2}, [traffic("AAA", "2010", 100), traffic("AAA", "2019", 200), traffic("BBB", "2019", 300)]])
    page(folder, "traffic", 2, [{"page": 2, "pages": 2}, [traffic("BBB", "2018", None), traffic("WLD", "2019", 900)]])
    page(folder, "ports", 1, features([port("p1"), port("p2")], True))
    page(folder, "ports", 2, features([port("p1", portname="Port one, again")]))
    page(folder, "connections", 1, features(legs or [leg("p1", "p2", 5.0), leg("p1", "p9", None), leg("p2", "p1", 3.0)]))
    daily = [(p, y, m, 1, 0, 0, 2, 0, 3) for p in ("p1", "p2", "p7") for y in (2021, 2022, 2023) for m in (1, 1, 2)]
    counts = ", ".join(f"portcalls_{t} int" for t in ("container", "dry_bulk", "general_cargo", "roro", "tanker"))
    spark.createDataFrame(daily, f"portid string, year int, month int, {counts}, portcalls int").write.mode(
        "overwrite"
    ).partitionBy("year").parquet(f"{folder}/daily_calls")


@pytest.fixture
def landed(spark, folder):
    land(spark, f"{folder}/landed")
    return f"{folder}/landed"


def test_all_jobs_twice(spark, store, landed, rows):
    inputs = landed_inputs(spark, landed, store)
    run_jobs(store, inputs, FIRST)

    assert rows(store.read(a.COUNTRY_DIM).select("country_iso3", "longitude", "latitude", "is_aggregate")) == [
        ("AAA", 1.5, None, False), ("BBB", 1.5, None, False), ("WLD", 1.5, None, True),
    ]
    assert rows(store.read(a.SUMMARY).select("country_iso3", "teu_2019", "teu_2010", "cagr_2010_2019", "rank_2019")) == [
        ("AAA", 200, 100, 0.0801, 2), ("BBB", 300, None, None, 1),
    ]
    assert rows(store.read(a.REGION_TOTALS)) == [("No", "North", 2010, 100, 1, 100), ("No", "North", 2019, 500, 2, 250)]
    assert rows(store.read(a.PORTS).select("portid", "portname")) == [("p1", "Port one, again"), ("p2", "Port p2")]
    monthly = store.read(a.CALLS)
    assert rows(monthly.groupBy("calls_year").agg(F.sum("calls_total"))) == [(2022, 27), (2023, 27)]
    assert rows(store.read(a.CALLS_MART).select("portid").distinct()) == [("p1",), ("p2",)]
    assert rows(store.read(a.CONNECTION_MART).select("from_portid", "to_portid", "to_continent", "rank_from_port")) == [
        ("p1", "p2", "Europe", 1), ("p1", "p9", None, 2), ("p2", "p1", "Europe", 1),
    ]

    registered = {r["asset_key"]: r for r in store.read(catalog.ASSET_TABLE).collect()}
    assert set(registered) == {asset.key for asset in a.ASSETS}
    calls_row = registered[a.CALLS]
    assert (calls_row["schema_name"], calls_row["table_name"], calls_row["layer"], calls_row["owner"]) == ("port_raw", "port_calls_monthly", "raw", "ops")
    assert (calls_row["last_row_count"], registered[a.PORTS]["last_row_count"], registered[a.PORTS]["last_batch_rows"]) == (12, 2, 3)

    edges = rows(store.read(catalog.EDGE_TABLE))
    assert edges == sorted((up, asset.key, "feeds") for asset in a.ASSETS if asset.layer == "mart" for up in asset.upstreams)
    fields = store.read(catalog.FIELD_TABLE)
    assert rows(fields.where("field_name = 'teu'").drop("description")) == [(a.TRAFFIC, "teu", "bigint", "TEU", False)]
    assert fields.select("asset_key").distinct().count() == 4
    checks = {(r["asset_key"], r["check_name"]): r for r in store.read(catalog.CHECK_TABLE).collect()}
    landed_assets = [asset.key for asset in a.ASSETS if asset.landed]
    assert len(checks) == sum(len(asset.checks) for asset in a.ASSETS) + len(landed_assets) + 1
    assert all(checks[(key, "pages_complete")]["detail"] == "all pages are there" for key in landed_assets)
    assert {k for k, r in checks.items() if not r["passed"]} == {(a.PORTS, "unique_port"), (a.CALLS_MART, "every_row_has_a_named_port")}
    assert checks[(a.CALLS_MART, "every_row_has_a_named_port")]["detail"] == "8 of 12 raw rows joined"

    # A second run: later calls, one port fewer in the batch, same everything else.
    page(landed, "ports", 1, features([port("p1")]))
    counts = ", ".join(f"portcalls_{t} int" for t in ("container", "dry_bulk", "general_cargo", "roro", "tanker"))
    late = spark.createDataFrame([("p1", 2024, 1, 9, 0, 0, 0, 0, 9)], f"portid string, year int, month int, {counts}, portcalls int")
    late.write.mode("append").partitionBy("year").parquet(f"{landed}/daily_calls")
    old_fields = rows(fields)
    run_jobs(store, inputs, SECOND)
    monthly = store.read(a.CALLS)
    assert rows(monthly.groupBy("calls_year").agg(F.sum("calls_total"))) == [(2022, 27), (2023, 27), (2024, 9)]
    assert store.read(catalog.METRIC_TABLE).groupBy("asset_key", "metric").count().where("count > 1").isEmpty()
    assert rows(store.read(a.PORTS).select("portid")) == [("p1",), ("p2",)]
    again = {r["asset_key"]: r for r in store.read(catalog.ASSET_TABLE).collect()}
    assert set(again) == set(registered)
    assert {(r["pipeline_uuid"], r["owner"], r["last_run_at"].month) for r in again.values()} == {("second", "ops", 2)}
    assert again[a.CALLS]["last_row_count"] == 13
    assert rows(store.read(catalog.EDGE_TABLE)) == edges
    assert rows(store.read(catalog.FIELD_TABLE)) == old_fields
    assert store.read(catalog.CHECK_TABLE).count() == len(checks)


CONNECTION_JOBS = [asset for asset in a.ASSETS if asset.key in (a.PORTS, a.CONNECTIONS, a.CONNECTION_MART)]


def test_mart_key_blocks_publication(spark, store, folder, rows):
    land(spark, f"{folder}/ok")
    run_jobs(store, landed_inputs(spark, f"{folder}/ok", store), FIRST, CONNECTION_JOBS)
    good = rows(store.read(a.CONNECTION_MART))
    land(spark, f"{folder}/bad", [leg("p1", "p2", 5.0), leg("p1", "p2", 6.0)])
    with pytest.raises(KeyViolation, match="port_connection_summary"):
        run_jobs(store, landed_inputs(spark, f"{folder}/bad", store), SECOND, CONNECTION_JOBS)
    assert rows(store.read(a.CONNECTION_MART)) == good
    # What did happen is recorded: the raw table was reloaded and its key check failed.
    checks = {(r["asset_key"], r["check_name"]): r["passed"] for r in store.read(catalog.CHECK_TABLE).collect()}
    assert checks[(a.CONNECTIONS, "unique_pair")] is False


def test_checks_are_advisory_unless_enforced(spark, store, folder, rows):
    only = [asset for asset in a.ASSETS if asset.key == a.CONNECTIONS]
    land(spark, f"{folder}/bad", [leg("p1", "p1", -1.0, days=0.0)])
    inputs = landed_inputs(spark, f"{folder}/bad", store)
    with pytest.raises(QualityFailure, match="no_self_legs"):
        run_jobs(store, inputs, FIRST, only, enforce=True)
    assert not store.exists(a.CONNECTIONS)
    run_jobs(store, inputs, FIRST, only)
    assert store.read(a.CONNECTIONS).count() == 1
    failed = store.read(catalog.CHECK_TABLE).where("NOT passed").select("check_name")
    assert rows(failed) == [("capacity_non_negative",), ("no_self_legs",), ("transit_days_positive",)]


def test_field_gone_from_the_source_stops_the_job(spark, store, folder):
    rows = [{k: v for k, v in port("p1").items() if k != "continent"}]
    page(f"{folder}/landed", "ports", 1, features(rows))
    only = [asset for asset in a.ASSETS if asset.key == a.PORTS]
    with pytest.raises(ValueError, match="continent"):
        run_jobs(store, landed_inputs(spark, f"{folder}/landed", store), FIRST, only)
    assert not store.exists(a.PORTS)


def test_a_renamed_figure_stops_the_job_and_keeps_the_table(spark, store, landed, rows):
    only = [asset for asset in a.ASSETS if asset.key in (a.COUNTRY_DIM, a.TRAFFIC)]
    inputs = landed_inputs(spark, landed, store)
    run_jobs(store, inputs, FIRST, only)
    before = rows(store.read(a.TRAFFIC))
    for number in (1, 2):
        path = pathlib.Path(landed, "traffic", f"page-{number:04d}.json")
        path.write_text(path.read_text().replace('"value": 1', '"figure": 1').replace('"value": 2', '"figure": 2')
                        .replace('"value": 3', '"figure": 3').replace('"value": 9', '"figure": 9').replace('"value": null', '"figure": null'))
    for name in ("value", "countryiso3code"):
        with pytest.raises(ValueError, match=name):
            run_jobs(store, inputs, SECOND, only)
        assert rows(store.read(a.TRAFFIC)) == before
        for number in (1, 2):
            path = pathlib.Path(landed, "traffic", f"page-{number:04d}.json")
            path.write_text(path.read_text().replace('"figure"', '"value"').replace("countryiso3code", "iso3"))


def test_missing_pages_are_a_failed_check(spark, store, landed, rows):
    for name in ("traffic", "ports"):
        pathlib.Path(landed, name, "page-0002.json").unlink()
    only = [asset for asset in a.ASSETS if asset.key in (a.COUNTRY_DIM, a.TRAFFIC, a.PORTS)]
    inputs = landed_inputs(spark, landed, store)
    run_jobs(store, inputs, FIRST, only)
    found = store.read(catalog.CHECK_TABLE).where("check_name = 'pages_complete' AND NOT passed").select("asset_key", "detail")
    assert rows(found) == [(a.TRAFFIC, "missing: 1"), (a.PORTS, "cut off: more was announced: 1")]
    for asset in only[1:]:
        with pytest.raises(QualityFailure, match="pages_complete"):
            run_jobs(store, inputs, SECOND, [asset], enforce=True)


def test_a_crashing_check_spares_the_others(spark, store, landed, rows):
    asset = next(asset for asset in a.ASSETS if asset.key == a.PORTS)
    crash = q.CountOf("crash", "CAST(portname AS INT) < 0", "never")
    run_jobs(store, landed_inputs(spark, landed, store), FIRST, [replace(asset, checks=(*asset.checks, crash))])
    found = {r["check_name"]: r for r in store.read(catalog.CHECK_TABLE).collect()}
    assert found["has_rows"]["passed"] and found["has_rows"]["detail"] == "3 rows"
    assert not found["crash"]["passed"] and found["crash"]["detail"].startswith("check crashed")


def test_checks_of_one_name_are_refused_and_runs_do_not_multiply(spark, store, landed):
    asset = next(asset for asset in a.ASSETS if asset.key == a.PORTS)
    inputs = landed_inputs(spark, landed, store)
    twice = replace(asset, checks=(*asset.checks, q.HasRows()))
    with pytest.raises(ValueError, match="has_rows"):
        run_jobs(store, inputs, FIRST, [twice])
    for _ in range(3):
        run_jobs(store, inputs, FIRST, [asset])
    assert store.read(catalog.CHECK_TABLE).count() == len(asset.checks) + 1


def test_pages_numbered_by_offset(spark, store, folder, rows):
    """Offsets 0, 1000, 2000 are the whole landing; a missing one is one gap of one page."""
    for at, more in ((0, True), (1000, True), (2000, False)):
        page(f"{folder}/landed", "ports", at, features([port(f"p{at}")], more))
    only = [asset for asset in a.ASSETS if asset.key == a.PORTS]
    inputs = landed_inputs(spark, f"{folder}/landed", store, page_steps={"ports": 1000})
    run_jobs(store, inputs, FIRST, only, enforce=True)
    assert store.read(a.PORTS).count() == 3
    pathlib.Path(folder, "landed", "ports", "page-1000.json").unlink()
    with pytest.raises(QualityFailure, match="pages_complete"):
        run_jobs(store, inputs, SECOND, only, enforce=True)
    found = store.read(catalog.CHECK_TABLE).where("check_name = 'pages_complete'").select("passed", "bad", "detail")
    assert rows(found) == [(False, 1, "missing: 1")]


def test_figures_come_from_the_write(spark, store, landed, rows):
    only = [asset for asset in a.ASSETS if asset.key in (a.COUNTRY_DIM, a.TRAFFIC, a.PORTS)]
    run_jobs(store, landed_inputs(spark, landed, store), FIRST, only)
    metrics = {(r["asset_key"], r["metric"]): r["value"] for r in store.read(catalog.METRIC_TABLE).collect()}
    assert metrics[(a.TRAFFIC, "landed_records")] == 5 and metrics[(a.TRAFFIC, "landed_bodies")] == 2
    assert metrics[(a.TRAFFIC, "rows_written")] == 3
    assert (metrics[(a.TRAFFIC, "min.traffic_year")], metrics[(a.TRAFFIC, "max.traffic_year")]) == (2010, 2019)
    assert metrics[(a.COUNTRY_DIM, "nulls.latitude")] == 3 and metrics[(a.COUNTRY_DIM, "nulls.longitude")] == 0
    assert metrics[(a.PORTS, "rows_written")] == 3 and (a.PORTS, "nulls.position") not in metrics
    sketch = store.read(catalog.SKETCH_TABLE).where(F.col("asset_key") == a.TRAFFIC)
    assert rows(sketch.select("column_name", F.hll_sketch_estimate("sketch"))) == [("country_iso3", 2)]


def test_distinct_counts_merge_over_runs(spark, store, landed, rows):
    asset = next(asset for asset in a.ASSETS if asset.key == a.CONNECTIONS)
    for run, legs in ((FIRST, [leg(f"p{i}", "q", 1.0) for i in range(300)]), (SECOND, [leg(f"p{i}", "q", 1.0) for i in range(200, 700)])):
        page(landed, "connections", 1, features(legs))
        run_jobs(store, landed_inputs(spark, landed, store), run, [replace(asset, distincts=("from_portid",))])
    sketches = store.read(catalog.SKETCH_TABLE)
    assert sketches.count() == 2
    each = rows(sketches.select(F.hll_sketch_estimate("sketch")))
    assert [abs(n - m) <= 0.02 * m for (n,), m in zip(each, (300, 500))] == [True, True]
    merged = rows(catalog.merged_distincts(sketches))
    assert merged[0][:2] == (a.CONNECTIONS, "from_portid") and abs(merged[0][2] - 700) <= 14


def test_fields_outside_the_list_are_listed(spark, store, landed, rows):
    page(landed, "ports", 2, features([port("p3", depth=7.5, berths=3), port("p4", depth=None, berths="many")]))
    only = [asset for asset in a.ASSETS if asset.key == a.PORTS]
    run_jobs(store, landed_inputs(spark, landed, store), FIRST, only)
    assert rows(store.read(catalog.UNLISTED_TABLE).select("field", "data_type", "records")) == [
        ("berths", "BIGINT", 1), ("berths", "STRING", 1), ("depth", "DECIMAL", 1), ("depth", "VOID", 1), ("fullname", "STRING", 4),
    ]


def test_docs_are_refreshed_on_request(spark, store, landed, rows):
    only = [asset for asset in a.ASSETS if asset.key == a.COUNTRY_DIM]
    inputs = landed_inputs(spark, landed, store)
    run_jobs(store, inputs, FIRST, only)
    renamed = [replace(only[0], docs={**only[0].docs, "country_name": ("A better text", None)})]
    name = "field_name = 'country_name'"
    run_jobs(store, inputs, SECOND, renamed)
    assert rows(store.read(catalog.FIELD_TABLE).where(name).select("description")) == [("Name to display",)]
    run_jobs(store, inputs, SECOND, renamed, refresh_docs=True)
    assert rows(store.read(catalog.FIELD_TABLE).where(name).select("description")) == [("A better text",)]
    stored = store.read(a.COUNTRY_DIM).schema["longitude"].metadata
    assert stored["unit"] == "degrees"


def test_undeclared_upstreams_are_refused(spark, store, landed):
    only = [asset for asset in a.ASSETS if asset.key == a.COUNTRY_DIM]
    run_jobs(store, landed_inputs(spark, landed, store), FIRST, only)
    text = MartText("SELECT country_iso3 FROM {dim} WHERE country_iso3 < :end", {"dim": a.COUNTRY_DIM}, {"end": "B"})
    mart = a.mart_asset("port_mart.codes", text, keys=("country_iso3",), checks=(q.HasRows(),), description="", grain="")
    run_jobs(store, landed_inputs(spark, landed, store), FIRST, [mart])
    assert [r[0] for r in store.read("port_mart.codes").collect()] == ["AAA"]
    with pytest.raises(ValueError, match="without declaring"):
        run_jobs(store, landed_inputs(spark, landed, store), FIRST, [replace(mart, upstreams=())])
    with pytest.raises(ValueError, match="declared are"):
        MartText("SELECT * FROM {other}", {"dim": a.COUNTRY_DIM})


def test_upstreams_run_first():
    order = [asset.key for asset in in_order(reversed(a.ASSETS))]
    for asset in a.ASSETS:
        assert all(order.index(up) < order.index(asset.key) for up in asset.upstreams)


def test_suites_name_each_check_once():
    for asset in a.ASSETS:
        names = [check.name for check in asset.checks]
        assert len(names) == len(set(names)) and isinstance(asset.checks[0], q.HasRows)

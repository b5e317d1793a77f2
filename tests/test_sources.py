import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from harborline.adapters import feature_bodies
from harborline.sources import landed, schemas


def bodies(spark, texts):
    rows = [(f"b{i}", i + 1, t if isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "source string, page int, body string")


def record(code, year, value):
    return {"country": {"id": code[:2], "value": code}, "countryiso3code": code, "date": year, "value": value, "extra": 1}


def feature(**attributes):
    return {"attributes": attributes}


def test_indicator_pages(spark, rows):
    landed_pages = bodies(spark, [
        [{"page": 1, "pages": 2}, [record("AAA", "2019", 1.5), record("BBB", "2019", None)]],
        [{"page": 2, "pages": 2}, [record("CCC", "2020", "NaN")]],
    ])
    got = landed.read_indicator_pages(landed_pages, schemas.INDICATOR_RECORD)
    assert got.columns == ["country", "countryiso3code", "date", "value"]
    assert rows(got.select("countryiso3code", "date", "value")) == [("AAA", "2019", 1.5), ("BBB", "2019", None), ("CCC", "2020", None)]


def test_null_records_are_an_empty_page(spark, rows):
    pages = bodies(spark, [[{"page": 1, "pages": 2}, None], [{"page": 2, "pages": 2}, [record("AAA", "2019", 1.0)]]])
    assert landed.read_indicator_pages(pages, schemas.INDICATOR_RECORD).count() == 1
    assert rows(landed.audit_indicator_pages(pages).select("page", "records", "issue")) == [
        (1, 0, "empty before the last page"), (2, 1, None),
    ]


@pytest.mark.parametrize("bad", ['[{"message": [{"id": "120"}]}]', '{"error": {"code": 400}}', "<html>busy</html>"])
def test_unreadable_indicator_body_stops_the_job(spark, bad):
    pages = bodies(spark, [[{"page": 1, "pages": 1}, []], bad])
    assert [r["source"] for r in landed.quarantine_indicator(pages).collect()] == ["b1"]
    with pytest.raises(PySparkException, match="in b1"):
        landed.read_indicator_pages(pages, schemas.INDICATOR_RECORD).collect()


def test_value_of_the_wrong_type_stops_the_job(spark):
    pages = bodies(spark, [[{"page": 1, "pages": 1}, [record("AAA", "2019", "many")]]])
    with pytest.raises(PySparkException):
        landed.read_indicator_pages(pages, schemas.INDICATOR_RECORD).collect()


def test_feature_pages_with_positions(spark, rows):
    pages = bodies(spark, [
        {"features": [feature(portid="p1", lat=1.0, other="x"), feature(portid="p2")], "exceededTransferLimit": True},
        {"features": []},
    ])
    got = landed.read_feature_pages(pages, "portid string, lat double", positions=True)
    assert got.columns == ["page", "position", "portid", "lat"]
    assert rows(got) == [(1, 0, "p1", 1.0), (1, 1, "p2", None)]


def test_error_body_is_quarantined(spark, rows):
    pages = bodies(spark, [{"features": [feature(portid="p1")]}, {"error": {"code": 400}}, {"error": None, "features": []}, "junk"])
    assert rows(landed.quarantine_features(pages).select("source", "problem")) == [
        ("b1", "error body"), ("b2", "error body"), ("b3", "not an object"),
    ]
    assert rows(landed.readable_features(pages).select("source")) == [("b0",)]
    # Three bodies are bad; which task meets one first is open.
    with pytest.raises(PySparkException, match="error body in b[12]|not an object in b3"):
        landed.read_feature_pages(pages, "portid string").collect()


def test_feature_audit(spark, rows):
    def page(n, more):
        return {"features": [feature(portid=str(i)) for i in range(n)], "exceededTransferLimit": more}

    texts = [page(3, True), page(0, True), page(2, False), page(2, True), page(1, True)]
    numbers = [1, 2, 3, 5, 7]
    pages = spark.createDataFrame(
        [(f"b{i}", n, json.dumps(t)) for i, (n, t) in enumerate(zip(numbers, texts))], "source string, page int, body string"
    )
    assert rows(landed.audit_feature_pages(pages)) == [
        (1, 1, 3, None), (2, 1, 0, "empty before the last page"), (3, 1, 2, "end announced too early"),
        (4, 0, 0, "missing"), (5, 1, 2, None), (6, 0, 0, "missing"), (7, 1, 1, "cut off: more was announced"),
    ]
    assert ("repeated",) in rows(landed.audit_feature_pages(pages.union(pages)).select("issue"))


def test_missing_pages_over_several_blocks(spark):
    last = 2 * landed.BLOCK + 5
    pages = bodies(spark, [[{"page": 1, "pages": last}, [record("AAA", "2019", 1.0)]]])
    audit = landed.audit_indicator_pages(pages)
    assert audit.where("issue = 'missing'").agg(F.count("*"), F.min("page"), F.max("page")).first() == (last - 1, 2, last)


def test_missing_fields(spark, rows):
    pages = bodies(spark, [[{"page": 1, "pages": 1}, [{"country": {"id": "A"}, "date": "2019"}, {"date": "2020", "value": None}]]])
    assert rows(landed.missing_fields(pages, schemas.INDICATOR_FIELDS, "indicator")) == [("country.value",), ("countryiso3code",)]
    ports = bodies(spark, [{"features": [feature(portid="p1"), feature(portname="x")]}])
    assert rows(landed.missing_fields(ports, ("portid", "portname", "lat"), "features")) == [("lat",)]


def test_read_bodies_from_files(spark, folder, rows):
    import pathlib

    for i in (1, 2):
        pathlib.Path(folder, f"page-{i:05d}.json").write_text(json.dumps({"features": [feature(portid=f"p{i}")]}, indent=1))
    found = landed.read_bodies(spark, folder)
    assert rows(found.select("page")) == [(1,), (2,)]
    assert rows(landed.read_feature_pages(found, "portid string")) == [("p1",), ("p2",)]
    found.write.parquet(f"{folder}/packed")
    packed = landed.read_bodies(spark, f"{folder}/packed", packed=True)
    assert rows(packed) == rows(found)


ATTRIBUTE = st.tuples(st.integers(0, 50), st.one_of(st.none(), st.text(max_size=8)), st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False)))


@settings(max_examples=8, deadline=None)
@given(st.lists(ATTRIBUTE, min_size=1, max_size=25))
def test_pack_and_parse_round_trip(spark, values):
    df = spark.createDataFrame(values, "k int, s string, v double")
    pages = feature_bodies(df, F.floor(F.col("k") / 10) + 1)
    got = landed.read_feature_pages(pages, "k int, s string, v double")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, df.collect()))


def test_require_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert schemas.require_columns(df, ("b", "a")).columns == ["b", "a"]
    with pytest.raises(ValueError, match="missing column"):
        schemas.require_columns(df, ("a", "z"))

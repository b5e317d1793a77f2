import pathlib
from dataclasses import replace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from harborline.operators.upserts import KeyViolation
from harborline.sinks.files import write_csv
from harborline.sinks.layout import Layout

KEYS = ("portid", "calls_year", "calls_month")
DDL = "portid string, calls_year int, calls_month int, calls_total bigint"


COLUMNS = [part.split()[0] for part in DDL.split(", ")]


def calls(spark, rows):
    return spark.createDataFrame(rows, DDL)


def contents(store, key):
    """The bytes of every file of a table."""
    return {p.as_posix(): p.read_bytes() for p in pathlib.Path(store.path(key)).rglob("*.parquet")}


def test_replace_may_change_columns(spark, store, rows):
    store.replace("raw.t", spark.createDataFrame([(1,)], "a int"))
    got = store.replace("raw.t", spark.createDataFrame([("x", 2)], "b string, c int"))
    assert rows(got) == rows(store.read("raw.t")) == [("x", 2)]


def test_reload_keeps_the_definition(spark, store, rows):
    store.reload("raw.t", spark.createDataFrame([(1, "x")], "a int, b string"))
    assert rows(store.reload("raw.t", spark.createDataFrame([("y", 2)], "b string, a int"))) == [(2, "y")]
    for bad in ("a int, b int", "a int, b string, c int", "a int", "a bigint, b string"):
        values = {"b int": 3, "b string": "z", "c int": 4}
        row = tuple([2, *[values[part] for part in bad.split(", ")[1:]]])
        with pytest.raises((ValueError, AnalysisException)):
            store.reload("raw.t", spark.createDataFrame([row], bad))
        assert rows(store.read("raw.t")) == [(2, "y")]


def test_reload_of_a_partitioned_table_clears_it(spark, store, rows):
    store.reload("raw.calls", calls(spark, [("p", 2021, 1, 1), ("p", 2022, 1, 2)]), ("calls_year",))
    got = store.reload("raw.calls", calls(spark, [("q", 2022, 1, 3)]), ("calls_year",))
    assert rows(got.select(*COLUMNS)) == [("q", 2022, 1, 3)]


def test_unpublished_content_is_invisible(spark, store, rows):
    store.replace("raw.t", spark.createDataFrame([(1,)], "a int"))
    reading = store.read("raw.t")
    commit = store.prepare("raw.t", spark.createDataFrame([(2,)], "a int"))
    assert rows(store.read("raw.t")) == [(1,)]
    store.publish(commit)
    assert rows(store.read("raw.t")) == [(2,)] and rows(reading) == [(1,)]


def test_upsert_touches_only_its_partitions(spark, store, rows):
    store.upsert("raw.calls", calls(spark, [("p", 2021, 1, 1), ("p", 2022, 1, 2), ("q", 2022, 1, 3)]), KEYS, "calls_year")
    before = contents(store, "raw.calls")
    got = store.upsert("raw.calls", calls(spark, [("p", 2022, 1, 20), ("p", 2023, 1, 4)]), KEYS, "calls_year")
    assert rows(got.select(*COLUMNS)) == [("p", 2021, 1, 1), ("p", 2022, 1, 20), ("p", 2023, 1, 4), ("q", 2022, 1, 3)]
    after = contents(store, "raw.calls")
    kept = {p: b for p, b in before.items() if "calls_year=2022" not in p}
    assert kept and all(after[p] == b for p, b in kept.items())
    assert {p.split("calls_year=")[1][:4] for p in after.keys() - before.keys()} == {"2022", "2023"}
    assert not any(p in after for p in before.keys() - kept.keys())


def test_upsert_is_idempotent(spark, store, rows):
    batch = calls(spark, [("p", 2022, 1, 20), ("q", 2022, 2, 4)])
    first = rows(store.upsert("raw.calls", batch, KEYS, "calls_year"))
    assert rows(store.upsert("raw.calls", batch, KEYS, "calls_year")) == first


@pytest.mark.parametrize("bad", [[("p", 2022, 1, 1), ("p", 2022, 1, 2)], [(None, 2022, 1, 1)]])
def test_upsert_refuses_broken_keys(spark, store, rows, bad):
    store.upsert("raw.calls", calls(spark, [("p", 2022, 1, 9)]), KEYS, "calls_year")
    with pytest.raises(KeyViolation):
        store.upsert("raw.calls", calls(spark, bad), KEYS, "calls_year")
    assert rows(store.read("raw.calls").select(*COLUMNS)) == [("p", 2022, 1, 9)]


def test_upsert_last_wins(spark, store, rows):
    ddl = "portid string, name string, page int, position int"
    store.replace("raw.ports", spark.createDataFrame([("a", "old"), ("z", "kept")], "portid string, name string"))
    batch = spark.createDataFrame([("a", "first", 1, 7), ("a", "last", 2, 0), ("b", None, 1, 0)], ddl)
    got = store.upsert("raw.ports", batch, ("portid",), position=("page", "position"))
    assert rows(got) == [("a", "last"), ("b", None), ("z", "kept")]


@pytest.mark.parametrize("partition", [None, "calls_year"])
def test_empty_batches(spark, store, rows, partition):
    empty = calls(spark, [])
    assert rows(store.upsert("raw.calls", empty, KEYS, partition)) == []
    assert sorted(store.read("raw.calls").columns) == sorted(empty.columns)
    store.upsert("raw.calls", calls(spark, [("p", 2022, 1, 1)]), KEYS, partition)
    assert rows(store.upsert("raw.calls", empty, KEYS, partition).select(*COLUMNS)) == [("p", 2022, 1, 1)]


def test_replace_hides_older_partitions(spark, store, rows):
    store.upsert("raw.calls", calls(spark, [("p", 2021, 1, 1)]), KEYS, "calls_year")
    store.upsert("raw.calls", calls(spark, [("p", 2022, 1, 1)]), KEYS, "calls_year")
    got = store.replace("raw.calls", calls(spark, [("q", 2023, 1, 1)]), ("calls_year",))
    assert rows(got.select(*COLUMNS)) == [("q", 2023, 1, 1)]
    assert store.vacuum("raw.calls") == 1 and store.vacuum("raw.calls") == 0
    assert rows(store.read("raw.calls").select(*COLUMNS)) == [("q", 2023, 1, 1)]


def test_partition_read_is_pruned(spark, store):
    store.replace("raw.calls", calls(spark, [("p", 2021, 1, 1), ("p", 2022, 1, 1)]), ("calls_year",))
    plan = store.read("raw.calls", {"calls_year": [2022]})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [calls_year" in plan.replace("isnotnull(calls_year", "calls_year") or "calls_year#" in plan
    assert "(calls_year" in plan.split("PartitionFilters")[1].split("]")[0]


def test_merge_and_add(spark, store, rows):
    ddl = "k string, note string, n int"
    store.merge_columns("reg.a", spark.createDataFrame([("x", "first", 1)], ddl), ("k",), ("n",))
    got = store.merge_columns("reg.a", spark.createDataFrame([("x", "second", 2), ("y", "new", 3)], ddl), ("k",), ("n",))
    assert rows(got) == [("x", "first", 2), ("y", "new", 3)]
    edge = spark.createDataFrame([("x", "y"), ("x", "y")], "f string, t string")
    store.add_rows("reg.e", edge)
    assert rows(store.add_rows("reg.e", edge)) == [("x", "y")]


def test_missing_table(store):
    with pytest.raises(FileNotFoundError):
        store.read("raw.nothing")


def test_csv(spark, folder, rows):
    df = spark.range(20).select("id", F.concat(F.lit("n, "), F.col("id").cast("string")).alias("name"))
    write_csv(df, f"{folder}/csv", single_file=True)
    assert len(list(pathlib.Path(folder, "csv").glob("part-*.csv"))) == 1
    assert rows(spark.read.schema(df.schema).option("header", "true").csv(f"{folder}/csv")) == rows(df)


def test_tables_are_there_in_sql(spark, store, rows):
    """K7: the database is made on the first write, and a table goes by its own name from then on."""
    assert not spark.catalog.databaseExists(f"{store.namespace}sql_raw")
    store.replace("sql_raw.plain", spark.createDataFrame([(1, "x")], "a int, b string"))
    assert spark.catalog.databaseExists(f"{store.namespace}sql_raw")
    assert rows(spark.sql(f"SELECT a, b FROM {store.name('sql_raw.plain')}")) == [(1, "x")]
    store.upsert("sql_raw.calls", calls(spark, []), KEYS, "calls_year")
    name = store.name("sql_raw.calls")
    assert spark.table(name).count() == 0
    store.upsert("sql_raw.calls", calls(spark, [("p", 2021, 1, 1), ("p", 2022, 1, 2)]), KEYS, "calls_year")
    store.upsert("sql_raw.calls", calls(spark, [("p", 2022, 1, 20)]), KEYS, "calls_year")
    assert rows(spark.table(name).select(*COLUMNS)) == [("p", 2021, 1, 1), ("p", 2022, 1, 20)]
    one_year = spark.sql(f"SELECT * FROM {name} WHERE calls_year = 2021")
    assert len(one_year.inputFiles()) >= 1 and one_year.count() == 1
    assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()} == {"calls_year=2021", "calls_year=2022"}


def test_partitioned_write_makes_few_files(spark, store):
    wide = spark.range(0, 4000, numPartitions=8).selectExpr(
        "CAST(id AS STRING) AS portid", "CAST(2020 + id % 3 AS INT) AS calls_year", "1 AS calls_month", "id AS calls_total"
    )
    store.replace("raw.calls", wide, ("calls_year",))
    assert len(list(pathlib.Path(store.path("raw.calls")).rglob("*.parquet"))) == 3
    assert store.read("raw.calls").count() == 4000


def test_partition_column_must_be_in_the_key(spark, store):
    batch = spark.createDataFrame([("k", 1)], "k string, y int")
    with pytest.raises(ValueError, match="part of the key"):
        store.upsert("s.t", batch, ("k",), "y")


def test_a_lookup_opens_few_files(spark, store):
    """Ranges in place of indexes: files do not overlap in the leading column, and Bloom filters are written."""
    layout = Layout(("country", "port"), ("port",), distinct=5_000, files=6)
    frame = spark.range(6000).selectExpr("CAST(id % 61 AS STRING) AS country", "CAST(id * 7919 % 6007 AS INT) AS port", "id AS n")
    store.publish(store.prepare("mart.t", frame, layout=layout))
    files = store.read("mart.t").groupBy(F.input_file_name().alias("file")).agg(
        F.min(F.struct("country", "port")).alias("low"), F.max(F.struct("country", "port")).alias("high")
    ).orderBy("low").collect()
    assert len(files) > 3
    assert all(tuple(a.high) < tuple(b.low) for a, b in zip(files, files[1:]))
    assert sum(f.low.country <= "30" <= f.high.country for f in files) <= 2
    plain = store.prepare("mart.u", frame, layout=replace(layout, lookups=()))
    size = lambda path: sum(p.stat().st_size for p in pathlib.Path(path).rglob("*.parquet"))
    assert size(store.path("mart.t")) > size(plain.path) + 6 * 1024
    assert store.read("mart.t").where("port = 5").count() == frame.where("port = 5").count()


def test_repeated_batch_keys_are_refused(spark, store):
    batch = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(KeyViolation):
        store.merge_columns("s.t", batch, ("k",), ("v",))

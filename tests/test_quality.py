from datetime import datetime, timezone

import pandas as pd
from hypothesis import given, settings, strategies as st

from harborline.operators import quality as q

AT = datetime(2024, 5, 1, tzinfo=timezone.utc)
DDL = "a string, b string, n bigint, d double"


def results(df, checks):
    found = q.run_checks(df, "raw.t", checks, AT)
    assert found.columns == ["asset_key", "check_name", "passed", "bad", "detail", "checked_at"]
    return {r["check_name"]: (r["passed"], r["bad"], r["detail"]) for r in found.collect()}


SUITE = (
    q.HasRows(), q.UniqueKey("unique", ("a", "b")), q.NoNulls("present", ("a", "b", "n")),
    q.NotEqual("no_self", "a", "b"), q.NonNegative("not_below", "n"), q.Positive("positive", "d"),
)


def test_findings(spark):
    df = spark.createDataFrame(
        [("x", "x", -1, 0.0), ("x", None, None, 1.0), ("x", None, 3, None), (None, "y", 4, -2.5)], DDL
    )
    got = results(df, SUITE)
    assert {k: v[:2] for k, v in got.items()} == {
        "has_rows": (True, 4), "unique": (False, 1), "present": (False, 3), "no_self": (False, 1),
        "not_below": (False, 1), "positive": (False, 2),
    }
    assert got["has_rows"][2] == "4 rows"
    assert got["present"][2] == "missing: a=1, b=2, n=1"
    assert "(a, b)" in got["unique"][2] and got["unique"][2].startswith("1 ")


def test_all_good(spark):
    got = results(spark.createDataFrame([("x", "y", 0, 1.0)], DDL), SUITE)
    assert all(v[0] for v in got.values())
    assert got["present"][2] == "complete: a, b, n"


def test_empty_frame_fails_only_has_rows(spark):
    got = results(spark.createDataFrame([], DDL), SUITE)
    assert {k for k, v in got.items() if not v[0]} == {"has_rows"}
    assert all(v[1] == 0 for v in got.values())


def test_missing_values_pass_comparisons(spark):
    got = results(spark.createDataFrame([(None, None, None, None)], DDL), SUITE)
    assert got["not_below"][0] and got["positive"][0] and got["no_self"][0] and not got["present"][0]


def test_crash_is_a_failure_and_spares_the_rest(spark):
    df = spark.createDataFrame([("it's", "y", 1, 1.0)], DDL)

    def broken(_):
        raise RuntimeError("it's broken")

    got = results(df, (
        q.HasRows(), q.NonNegative("no_such", "zzz"), q.NonNegative("text", "a"), q.UniqueKey("no_key", ("zzz",)),
        q.Custom("broken", broken), q.Custom("own", lambda frame: (frame.count() == 1, "it's one")),
    ))
    assert {k: v[0] for k, v in got.items()} == {
        "has_rows": True, "no_such": False, "text": False, "no_key": False, "broken": False, "own": True,
    }
    assert got["broken"][2] == "check crashed: it's broken" and got["own"][2] == "it's one"
    assert got["no_such"][2].startswith("check crashed: ") and got["text"][2].endswith("not numeric")


def test_one_scan_for_plain_checks_and_one_per_key(spark, folder):
    spark.createDataFrame([("x", "y", 0, 1.0)], DDL).write.parquet(f"{folder}/t")
    found = q._measured(spark.read.parquet(f"{folder}/t"), SUITE)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert any("ReadSchema: struct<a:string,b:string>" in part for part in plan.split("FileScan parquet"))


KEYS = st.lists(st.tuples(st.sampled_from([None, "x", "y"]), st.sampled_from([None, "x"])), max_size=20)


@settings(max_examples=10, deadline=None)
@given(KEYS)
def test_duplicates_like_pandas(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    want = int(pd.DataFrame(pairs, columns=["a", "b"]).duplicated(subset=["a", "b"]).sum())
    assert q.duplicate_rows(df, ("a", "b")).first()["dupes"] == want


def test_null_counts(spark, rows):
    df = spark.createDataFrame([("x", None, 1, None), (None, None, 2, 1.0)], DDL)
    assert rows(q.null_counts(df, ("a", "b", "n"))) == [("a", 1), ("b", 2), ("n", 0)]


def test_row_parity(spark):
    row = q.row_parity(spark.range(3), spark.range(5)).first()
    assert (row["passed"], row["raw_rows"], row["mart_rows"], row["detail"]) == (False, 5, 3, "3 of 5 raw rows joined")
    assert q.row_parity(spark.range(0), spark.range(0)).first()["passed"]

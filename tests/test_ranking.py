import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Window, functions as F

from harborline.operators import ranking

VALUES = st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1), st.integers(-3, 3), st.integers(2**21 - 2, 2**21 + 2))


@settings(max_examples=12, deadline=None)
@given(st.lists(VALUES, min_size=1, max_size=40))
def test_global_rank_equals_rank_and_pandas(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v bigint")
    got = {r["i"]: r["rank"] for r in ranking.rank_min_desc(df, "v", "rank").collect()}
    window = F.when(F.col("v").isNotNull(), F.rank().over(Window.orderBy(F.desc("v"))))
    assert got == {r["i"]: r["w"] for r in df.withColumn("w", window).collect()}
    # As whole numbers: pandas' floats could not tell the large values apart.
    known = pd.Series({i: v for i, v in enumerate(values) if v is not None}, dtype="int64")
    want = known.rank(ascending=False, method="min").astype("int64").to_dict()
    assert got == {i: want.get(i) for i in range(len(values))}


def test_global_rank_of_nothing(spark):
    empty = spark.createDataFrame([], "v bigint")
    assert ranking.rank_min_desc(empty, "v", "r").columns == ["v", "r"]
    nulls = spark.createDataFrame([(None,), (None,)], "v bigint")
    assert [r["r"] for r in ranking.rank_min_desc(nulls, "v", "r").collect()] == [None, None]


def test_global_rank_wants_whole_numbers(spark):
    with pytest.raises(TypeError):
        ranking.rank_min_desc(spark.createDataFrame([(1.5,)], "v double"), "v", "r")


def test_rows_meet_no_unpartitioned_window(spark):
    plan = ranking.rank_min_desc(spark.range(10), "id", "r")._jdf.queryExecution().optimizedPlan().toString()
    single = [line for line in plan.splitlines() if "Window" in line and "_top#" in line and "_middle#" not in line]
    # The one window without a partition is over leading digits, at most 2**22 rows.
    assert len([line for line in plan.splitlines() if "Window [" in line]) == 3
    assert all("_n#" in line for line in single)


GROUPED = st.lists(
    st.tuples(st.sampled_from([None, 1, 2]), st.one_of(st.none(), st.integers(0, 4))), min_size=1, max_size=60
)


@settings(max_examples=8, deadline=None)
@given(GROUPED)
def test_rank_equals_window(spark, groups):
    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(groups)], "g int, v int, i int")
    number = F.row_number().over(Window.partitionBy("g").orderBy(F.desc_nulls_last("v"), "i"))
    got = ranking.rank_within(df, "g", "v", "i", "place").collect()
    assert sorted(got, key=repr) == sorted(df.withColumn("place", number).collect(), key=repr)


def test_a_group_of_a_third_of_the_rows_is_sliced(spark):
    group = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 200)
    df = spark.range(6000).select(group.alias("g"), (F.hash("id") % 50).alias("v"), "id")
    ranked = ranking.rank_within(df, "g", "v", "id", "place")
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    # The one window sees a row for each group and slice, and no row of the table.
    assert plan.count("Window [") == 1 and "hint" not in plan.lower()
    window = plan[plan.index("Window [") :]
    assert "Aggregate" in window
    number = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("v"), "id"))
    assert sorted(ranked.collect()) == sorted(df.withColumn("place", number).collect())

"""Plans and behaviour when one key holds a third of all rows."""

import pathlib
import re

import pytest
from pyspark.sql import functions as F

from harborline.operators import calls, traffic
from harborline.session import apply_settings, scratch_path, scratch_scope, shared_folder, shuffle_partitions_for, stage

TIGHT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.shuffle.partitions": "24",
}


@pytest.fixture
def tight(spark):
    """Sizes at which a small table behaves like a large one: nothing is broadcast."""
    before = {k: spark.conf.get(k, None) for k in TIGHT}
    for k, v in TIGHT.items():
        spark.conf.set(k, v)
    apply_settings(spark)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def skewed(tight):
    """A third of the traffic is that of one country."""
    code = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("C"), (F.col("id") % 3000).cast("string")))
    rows = tight.range(0, 300_000, numPartitions=16).select(
        code.alias("country_iso3"), code.alias("country_name"),
        (F.lit(2000) + F.col("id") % 20).cast("int").alias("traffic_year"), F.hash("id").cast("bigint").alias("teu"),
    )
    facts = stage(rows, "facts")
    dims = stage(
        rows.select("country_iso3").distinct().select(
            "country_iso3", F.lit("R").alias("region_code"), F.lit("Region").alias("region_name"),
            F.lit(1.0).alias("longitude"), F.lit(1.0).alias("latitude"), F.lit(False).alias("is_aggregate"),
        ),
        "dims",
    )
    return facts, dims


def test_hot_country_is_split_in_joins(skewed):
    facts, dims = skewed
    plan = final_plan(traffic.region_totals(facts, dims))
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_country_is_split_before_a_grouping_by_the_same_key(skewed):
    facts, dims = skewed
    joined = traffic.enrich_traffic(facts, dims)
    plan = final_plan(joined.groupBy("country_iso3", "region_code").agg(F.max("teu")))
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_country_summary_is_right(skewed):
    facts, dims = skewed
    got = traffic.country_summary(traffic.enrich_traffic(facts, dims)).where("country_iso3 = 'HOT'").first()
    want = facts.where("country_iso3 = 'HOT'").agg(
        F.max(F.struct("traffic_year", "teu")), F.max(F.when(F.col("traffic_year") == 2010, F.col("teu")))
    ).first()
    assert ((got.latest_year, got.latest_teu), got.teu_2010) == (tuple(want[0]), want[1])


def test_small_dimension_is_broadcast(spark, skewed):
    facts, dims = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    plan = final_plan(traffic.enrich_traffic(facts, dims))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark, skewed):
    facts, dims = skewed
    plan = traffic.region_totals(facts, dims)._jdf.queryExecution().executedPlan().toString()
    assert "country_name" not in plan
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(is_aggregate\)[^\]]*\]", plan)


def test_roll_up_combines_before_the_shuffle(spark):
    daily = spark.range(10).selectExpr(
        "'p' AS portid", "2020 AS year", "1 AS month", "1 AS portcalls",
        *[f"1 AS portcalls_{t}" for t in ("container", "dry_bulk", "general_cargo", "roro", "tanker")],
    )
    plan = calls.roll_up_months(daily)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "SortAggregate" not in plan


def test_scratch_is_under_the_named_folder_and_cleared(spark):
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    with scratch_scope(spark):
        inside = stage(spark.range(3), "inside")
        path = pathlib.Path(re.sub("^file:/*", "/", inside.inputFiles()[0])).parent
        assert path.exists()
    assert not path.exists()
    assert stage(spark.range(3), "outside").count() == 3


def test_shuffle_width():
    assert shuffle_partitions_for(0, 8) == 8
    assert shuffle_partitions_for(100 * 2**40, 4000) % 4000 == 0
    assert shuffle_partitions_for(100 * 2**40, 4000) >= 100 * 2**40 // (200 * 2**20)


def test_engine_has_no_row_by_row_python():
    root = pathlib.Path(__file__).parent.parent / "harborline"
    # The training-data operators name their own styles.
    text = "\n".join(p.read_text() for p in root.rglob("*.py") if "llm" not in p.parts)
    for word in ("toPandas", "localCheckpoint", ".rdd", "pandas_udf", "F.udf", "crossJoin", "applyInPandas"):
        assert word not in text

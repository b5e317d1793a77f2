import pytest
from hypothesis import given, settings, strategies as st

from harborline.operators import upserts
from harborline.operators.upserts import KeyViolation

KEYED = st.dictionaries(st.integers(0, 12), st.one_of(st.none(), st.integers(0, 5)), max_size=10)


def frame(spark, pairs):
    return spark.createDataFrame(list(pairs.items()), "k int, v int")


@settings(max_examples=10, deadline=None)
@given(KEYED, KEYED)
def test_upsert_is_a_dict_update_and_idempotent(spark, target, batch):
    t, b = frame(spark, target), frame(spark, batch)
    once = upserts.upsert(t, b, ("k",))
    assert {r["k"]: r["v"] for r in once.collect()} == {**target, **batch}
    assert sorted(map(tuple, upserts.upsert(once, b, ("k",)).collect()), key=repr) == sorted(map(tuple, once.collect()), key=repr)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 9))), max_size=25))
def test_last_wins(spark, batch):
    df = spark.createDataFrame([(k, v, i // 5, i % 5) for i, (k, v) in enumerate(batch)], "k int, v int, page int, position int")
    got = upserts.last_wins(df, ("k",), ("page", "position"))
    assert got.columns == ["k", "v"]
    assert {r["k"]: r["v"] for r in got.collect()} == dict(batch)


def test_last_wins_reduces_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "k int, v int, page int, position int")
    plan = upserts.last_wins(df, ("k",), ("page", "position"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_partial_upsert_keeps_and_refreshes(spark, rows):
    target = spark.createDataFrame([(1, "a", None), (2, None, 5)], "k int, note string, n int")
    batch = spark.createDataFrame([(2, "new", None), (3, "c", 7)], "k int, note string, n int")
    got = upserts.partial_upsert(target, batch, ("k",), ("n",))
    # Key 2: the note stays NULL though the batch has one; n becomes NULL though the target had one.
    assert rows(got) == [(1, "a", None), (2, None, None), (3, "c", 7)]


def test_insert_ignore(spark, rows):
    edges = "f string, t string"
    got = upserts.insert_ignore(spark.createDataFrame([("a", "b")], edges), spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "c")], edges))
    assert rows(got) == [("a", "b"), ("a", "c")]


def test_key_violations(spark, rows):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "y")], "a int, b string")
    assert rows(upserts.key_violations(df, ("a", "b"))) == [(1, "x", 2), (2, None, 1)]
    with pytest.raises(KeyViolation, match="rows"):
        upserts.assert_key(df, ("a", "b"), "table")
    assert upserts.assert_key(df.where("a = 3"), ("a", "b"), "table").count() == 1

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retailweave.functions import statistics


def quantile(spark, values, q=0.5, column_type="double", **options):
    df = spark.createDataFrame([(v,) for v in values], f"x {column_type}")
    return statistics.exact_quantile(df, "x", q, **options).first().value


@pytest.mark.parametrize(
    "values, expected",
    [
        ([20.0, 30.0, None], 20.0),
        ([10.0, 20.0, 30.0, 40.0], 20.0),
        ([10.0, 20.0, 30.0, 40.0, None, None], 20.0),
        ([1.0, 2.0, 3.0, 4.0, 5.0], 3.0),
        ([1.0, 2.0, 3.0, math.nan, math.nan], 2.0),
        ([7.5], 7.5),
        ([None, None], None),
        ([], None),
    ],
)
def test_lower_median(spark, values, expected):
    assert quantile(spark, values) == expected


@pytest.mark.parametrize("column_type", ["tinyint", "int", "bigint"])
def test_integers_give_a_double(spark, column_type):
    assert quantile(spark, [3, 1, 2, None], column_type=column_type) == 2.0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=60),
    st.sampled_from([0.0, 0.25, 0.5, 0.75, 1.0]),
)
def test_equals_the_sorted_list(spark, values, q):
    ordered = sorted(values)
    assert quantile(spark, values, q) == ordered[max(math.ceil(q * len(ordered)), 1) - 1]


@pytest.mark.parametrize("accuracy", [20, 200, 2000])
def test_many_values_over_many_partitions(spark, accuracy):
    """Coarse sketches narrow less and still give the exact element."""
    df = spark.range(0, 50_000, 1, 16).select((F.col("id") * 7919 % 50_000 / 3).alias("x"))
    assert statistics.exact_quantile(df, "x", 0.5, accuracy).first().value == 24_999 / 3


@pytest.mark.parametrize("partitions", [3, 150, 300])
@pytest.mark.parametrize("q", [0.01, 0.5, 0.99])
def test_sorted_partitions_of_unequal_size(spark, partitions, q):
    """Each partition holds a range of its own, so the groups of tasks differ as much as they can."""
    df = spark.range(0, 60_000, 1, partitions).where("id < 20000 OR id % 7 = 0").select("id")
    values = [i for i in range(60_000) if i < 20_000 or i % 7 == 0]
    assert statistics.exact_quantile(df, "id", q).first().value == values[math.ceil(q * len(values)) - 1]


def test_hot_value(spark):
    """A third of the rows share one value, on either side of the median or at it."""
    for hot in (0, 5_000, 15_000):
        df = spark.range(0, 30_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, hot).otherwise(F.col("id") % 10_007).alias("x")
        )
        values = sorted(hot if i % 3 == 0 else i % 10_007 for i in range(30_000))
        assert statistics.exact_quantile(df, "x").first().value == values[14_999]


def test_heavy_tail(spark):
    df = spark.range(0, 9_999, 1, 8).select(F.exp(F.col("id") / 20.0).alias("x"))
    expected = df.orderBy("x").collect()[4_999].x
    assert statistics.exact_quantile(df, "x").first().value == expected


@pytest.fixture
def counted(monkeypatch):
    """Distinct values that each final count had to hold."""
    real, seen = statistics._counts, []

    def counts(values, a, b, q):
        if q is not None:
            inside = values.where((F.col("value") >= a) & (F.col("value") <= b))
            seen.append(inside.agg(F.count_distinct("value")).first()[0])
        return real(values, a, b, q)

    monkeypatch.setattr(statistics, "_counts", counts)
    return seen


@pytest.mark.parametrize("n", [100_000, 1_000_000, 4_000_000])
def test_the_last_task_holds_few_values(spark, counted, n):
    df = spark.range(0, n, 1, 16).select((F.col("id") * 7919 % n / 3).alias("x"))
    assert statistics.exact_quantile(df, "x").first().value == (n // 2 - 1) / 3
    assert len(counted) == 1 and counted[0] <= 1.5 * statistics.COUNTED_ROWS


def test_rounds_go_on_to_a_handful_of_rows(spark, counted):
    df = spark.range(0, 200_000, 1, 16).select((F.col("id") * 7919 % 200_000).alias("x"))
    for q in (0.0, 0.001, 0.5, 0.75, 1.0):
        value = statistics.exact_quantile(df, "x", q, counted_rows=20).first().value
        assert value == max(math.ceil(q * 200_000), 1) - 1
    assert max(counted) <= 60


def test_rounds_with_hot_values(spark):
    """The answer is a hot value, or one of many between two hot ones."""
    df = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, 1_000_000).otherwise(F.col("id")).alias("x")
    )
    values = sorted(0 if i % 3 == 0 else 1_000_000 if i % 3 == 1 else i for i in range(60_000))
    for q in (0.1, 1 / 3, 0.334, 0.5, 0.666, 0.7):
        assert statistics.exact_quantile(df, "x", q, counted_rows=50).first().value == values[math.ceil(q * 60_000) - 1]


def test_a_sketch_that_misses_its_bound_does_not_end_the_search(spark, monkeypatch):
    real, wrong = statistics._weighted, [100.0, 200.0, 49_000.0, 49_500.0]
    monkeypatch.setattr(statistics, "_weighted", lambda groups, share: wrong.pop(0) if wrong else real(groups, share))
    df = spark.range(0, 50_000, 1, 8)
    assert statistics.exact_quantile(df, "id", counted_rows=100).first().value == 24_999


def test_infinite_values_count(spark):
    assert quantile(spark, [math.inf, -math.inf, 1.0, math.inf]) == 1.0
    assert quantile(spark, [math.inf, math.inf, 1.0]) == math.inf
    assert quantile(spark, [math.inf, 1.0, 2.0], 0.99, counted_rows=0) == math.inf


@pytest.mark.parametrize(
    "values, expected",
    [
        ([None, None, None, 1, 2], None),
        ([1, 1, 2, 2, None], 1),
        ([2, 2, 1, None], 2),
        ([None], None),
    ],
)
def test_mode_counts_null_and_breaks_ties_by_value(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    assert statistics.mode(df, "x").collect() == [(expected,)]


def test_mode_of_nothing_is_no_row(spark):
    assert statistics.mode(spark.createDataFrame([], "x int"), "x").collect() == []


def test_top_groups_are_not_fully_sorted(spark, plan):
    df = spark.range(100).select((F.col("id") % 7).alias("x"))
    top = statistics.top_groups(df, "x", 3)
    assert [tuple(row) for row in top.collect()] == [(0, 15), (1, 15), (2, 14)]
    assert "TakeOrderedAndProject(limit=3" in plan(top)

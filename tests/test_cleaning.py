import datetime
import math

import pytest
from pyspark.sql import functions as F

from retailweave.functions import columns
from retailweave.operators import cleaning, entities

from conftest import rows


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_median_fill_is_the_lower_median_as_double(spark):
    df = spark.createDataFrame([(20,), (30,), (None,)], "age int")
    filled = cleaning.impute_median(df, "age")
    assert values(filled, "age") == [20.0, 30.0, 20.0]
    assert filled.schema["age"].dataType.simpleString() == "double"


def test_known_median_is_used_as_given(spark):
    df = spark.createDataFrame([(20,), (None,)], "age int")
    assert values(cleaning.impute_median(df, "age", F.lit(42)), "age") == [20.0, 42.0]


@pytest.mark.parametrize(
    "channels, expected",
    [
        ([None, None, None, 1, 2], [None, None, None, 1, 2]),
        ([1, 1, 2, 2, None], [1, 1, 2, 2, 1]),
        ([2, None, 2, 1], [2, 2, 2, 1]),
        ([], []),
    ],
)
@pytest.mark.parametrize("column_type", ["int", "string"])
def test_mode_fill_keeps_the_type(spark, channels, expected, column_type):
    kind = {"int": int, "string": str}[column_type]
    channels = [None if c is None else kind(c) for c in channels]
    df = spark.createDataFrame([(c,) for c in channels], f"channel {column_type}")
    filled = cleaning.impute_mode(df, "channel")
    assert values(filled, "channel") == [None if c is None else kind(c) for c in expected]
    assert filled.schema == df.schema


def test_mode_fill_ignores_column_case(spark):
    df = spark.createDataFrame([(1,), (None,), (1,)], "Channel int")
    assert values(cleaning.impute_mode(df, "channel"), "channel") == [1, 1, 1]


def test_fill_in_plan_needs_no_join(spark, plan):
    df = spark.createDataFrame([(1,), (None,)], "channel int")
    text = plan(cleaning.impute_mode(df, "channel"))
    assert "Subquery" in text and "Join" not in text


def test_constant_fill_and_replacement(spark):
    df = spark.createDataFrame([("None",), ("NONE",), ("none",), ("Regularly",), (None,)], "news string")
    replaced = cleaning.replace_values(df, "news", ["None", "NONE"], "Never")
    assert values(replaced, "news") == ["Never", "Never", "none", "Regularly", None]
    filled = cleaning.fill_constant(replaced, news="Never")
    assert values(filled, "news") == ["Never", "Never", "none", "Regularly", "Never"]
    assert rows(cleaning.fill_constant(filled, news="Never")) == rows(filled)


@pytest.mark.parametrize(
    "age, group",
    [
        (-1, "Silent"),
        (0, "Gen-Z"),
        (21.5, "Gen-Z"),
        (22, "Millennials"),
        (38, "Gen-X"),
        (54, "Boomers"),
        (72.9, "Boomers"),
        (73, "Silent"),
        (100, "Silent"),
        (math.nan, "Silent"),
        (None, "Silent"),
    ],
)
def test_bins_are_half_open(spark, age, group):
    df = spark.createDataFrame([(None if age is None else float(age),)], "age double")
    binned = columns.bucketize("age", entities.AGE_EDGES, entities.AGE_LABELS, entities.AGE_OTHERWISE)
    assert df.select(binned).first()[0] == group


def test_bins_and_labels_must_agree():
    with pytest.raises(ValueError, match="2 bins, got 1"):
        columns.bucketize("age", [0, 1, 2], ["a"], "b")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_text_that_is_no_date_becomes_null(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("2018-09-20",), ("x",), (None,)], "t_dat string")
        dated = [tuple(row) for row in cleaning.add_calendar(df, "t_dat").collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert dated == [
        (datetime.date(2018, 9, 20), "September", "Thursday", 3, 2018),
        (None,) * 5,
        (None,) * 5,
    ]


def test_calendar_names_equal_formatted_dates(spark):
    days = spark.range(0, 4000).select(F.date_add(F.lit("1995-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    formatted = days.select("d", F.date_format("d", "MMMM"), F.date_format("d", "EEEE"), F.quarter("d"), F.year("d"))
    assert rows(cleaning.add_calendar(days, "d")) == rows(formatted)


def test_timestamps_and_dates_pass_as_dates(spark):
    df = spark.sql("SELECT timestamp_ntz'2020-02-29 23:59:59' AS a, timestamp'2020-02-29 23:59:59' AS b")
    row = df.select(columns.to_date("a"), columns.to_date("b")).first()
    assert row == (datetime.date(2020, 2, 29), datetime.date(2020, 2, 29))


CUSTOMERS = (
    "customer_id string, FN double, Active double, club_member_status string, "
    "fashion_news_frequency string, age double, postal_code string"
)


def test_customers(spark):
    df = spark.createDataFrame(
        [
            ("a", 1.0, 1.0, "ACTIVE", "Regularly", 21.5, "p"),
            ("b", None, None, None, None, None, None),
            ("c", None, 1.0, "LEFT CLUB", "NONE", 73.0, "q"),
            ("d", None, None, "PRE-CREATE", "None", 30.0, "q"),
        ],
        CUSTOMERS,
    )
    cleaned = entities.clean_customers(df)
    assert cleaned.dtypes == [
        ("customer_id", "string"),
        ("active_status", "string"),
        ("club_member_status", "string"),
        ("fashion_news_frequency", "string"),
        ("age", "int"),
        ("postal_code", "string"),
        ("age_group", "string"),
    ]
    assert rows(cleaned) == [
        ("a", "1.0", "ACTIVE", "Regularly", 21, "p", "Gen-Z"),
        ("b", "0", "ACTIVE", "Never", 30, None, "Millennials"),
        ("c", "1.0", "LEFT CLUB", "Never", 73, "q", "Silent"),
        ("d", "0", "PRE-CREATE", "Never", 30, "q", "Millennials"),
    ]


def test_customers_without_any_age(spark):
    df = spark.createDataFrame([("a", None, None, None, None, None, None)] * 2, CUSTOMERS)
    assert [(row.age, row.age_group) for row in entities.clean_customers(df).collect()] == [(None, "Silent")] * 2


def test_customers_with_a_nan_age(spark):
    df = spark.createDataFrame([("a", None, None, None, None, math.nan, None)], CUSTOMERS)
    assert [(row.age, row.age_group) for row in entities.clean_customers(df).collect()] == [(None, "Silent")]


def test_customers_ignore_column_case_and_missing_fn(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", "y", 5)],
        "customer_id string, active int, CLUB_member_status string, Fashion_News_Frequency string, AGE int",
    )
    cleaned = entities.clean_customers(df)
    assert "active_status" in cleaned.columns
    assert cleaned.first().active_status == "1"


def test_articles(spark):
    df = spark.createDataFrame([(1, "x", "long")], "article_id int, prod_name string, detail_desc string")
    assert entities.clean_articles(df).columns == ["article_id", "prod_name"]
    assert entities.clean_articles(df.drop("detail_desc")).columns == ["article_id", "prod_name"]


TRANSACTIONS = "t_dat string, customer_id string, article_id int, price double, sales_channel_id int"


def test_transactions(spark):
    df = spark.createDataFrame(
        [
            ("2018-09-20", "a", 1, 0.5, 2),
            ("2019-01-06", "a", 1, 0.5, None),
            ("bad", "b", 2, 0.1, 2),
            (None, None, None, None, 1),
        ],
        TRANSACTIONS,
    )
    cleaned = entities.clean_transactions(df)
    assert cleaned.columns == df.columns + ["month", "day", "quarter", "year"]
    assert rows(cleaned) == rows(
        spark.createDataFrame(
            [
                (datetime.date(2018, 9, 20), "a", 1, 0.5, 2, "September", "Thursday", 3, 2018),
                (datetime.date(2019, 1, 6), "a", 1, 0.5, 2, "January", "Sunday", 1, 2019),
                (None, "b", 2, 0.1, 2, None, None, None, None),
                (None, None, None, None, 1, None, None, None, None),
            ],
            cleaned.schema,
        )
    )


def test_no_transactions(spark):
    cleaned = entities.clean_transactions(spark.createDataFrame([], TRANSACTIONS))
    assert cleaned.collect() == []
    assert dict(cleaned.dtypes) == {
        "t_dat": "date",
        "customer_id": "string",
        "article_id": "int",
        "price": "double",
        "sales_channel_id": "int",
        "month": "string",
        "day": "string",
        "quarter": "int",
        "year": "int",
    }

"""The raw views hold what the operators must handle."""

import pytest
from pyspark.sql import functions as F

from retailweave.registry import fixtures

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("view, table", [("customers_raw", "customer"), ("articles_raw", "part"), ("transactions_raw", "lineitem")])
def test_views_keep_every_row(spark, view, table):
    assert fixtures.raw(spark, SF, view).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_customers(spark):
    df = fixtures.customers(spark, SF)
    nulls = df.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in df.columns)).first().asDict()
    assert all(nulls[name] > 0 for name in ("FN", "Active", "club_member_status", "fashion_news_frequency", "age"))
    ages = {row.age for row in df.select("age").distinct().collect()}
    assert {21, 22, 37, 38, 53, 54, 72, 73} <= ages


def test_transactions(spark):
    df = fixtures.transactions(spark, SF)
    customers, articles = fixtures.customers(spark, SF), fixtures.articles(spark, SF)
    assert df.where("customer_id IS NULL").count() > 0
    assert df.where("customer_id IS NOT NULL").join(customers, "customer_id", "left_anti").count() > 0
    assert df.join(articles, "article_id", "left_anti").count() > 0
    assert df.where("t_dat IS NULL").count() > 0 and df.where("t_dat = 'no date'").count() > 0
    assert df.where("sales_channel_id IS NULL").count() > 0


def test_hot_customer(spark):
    df = fixtures.hot_transactions(spark, SF)
    assert df.where("customer_id = '1'").count() > df.count() / 3

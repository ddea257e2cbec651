import dataclasses
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from retailweave.plans import jobs as plans
from retailweave.plans.jobs import Jobs, run_historic, run_live
from retailweave.sinks.writers import Warehouse
from retailweave.sources.snapshots import feed_path

from conftest import rows


@pytest.fixture
def jobs(spark, tmp_path):
    customers = spark.createDataFrame(
        [("c1", 1.0, 1, "ACTIVE", "NONE", 30), ("c2", None, None, None, None, None), ("c3", None, 1, "X", "Y", 80)],
        "customer_id string, FN double, Active int, club_member_status string, "
        "fashion_news_frequency string, age int",
    )
    articles = spark.createDataFrame([(1, "a", "long"), (2, "b", "long")], "article_id int, name string, detail_desc string")
    historic = spark.createDataFrame(
        [("2018-09-20", "c1", 1, 2), ("2018-09-21", "c2", 2, None), ("2018-09-22", "c9", 1, 2), ("x", "c3", 1, 1)],
        "t_dat string, customer_id string, article_id int, sales_channel_id int",
    )
    live = spark.createDataFrame(
        [("2020-01-01", "c1", 1, 1), ("2020-01-02", "c2", 2, None)], historic.schema
    )

    def sources(transactions):
        return {"Customers": lambda _: customers, "Articles": lambda _: articles, "Transactions": lambda _: transactions}

    return Jobs(
        lake=str(tmp_path / "lake"),
        warehouse=Warehouse("parquet", {"path": str(tmp_path / "tables")}),
        sources={plans.HISTORIC: sources(historic), plans.LIVE: sources(live)},
    )


def tables(spark, jobs):
    path = jobs.warehouse.options["path"]
    return {name: spark.read.parquet(f"{path}/{name}") for name in ("warehouse", "customers", "articles", "transactions")}


def counts(spark, jobs):
    return {name: df.count() for name, df in tables(spark, jobs).items()}


def test_historic_run(spark, jobs):
    run_historic(spark, jobs, "2024-01-31")
    written = tables(spark, jobs)
    assert written["warehouse"].columns == [
        "article_id",
        "customer_id",
        "t_dat",
        "sales_channel_id",
        "month",
        "day",
        "quarter",
        "year",
        "active_status",
        "club_member_status",
        "fashion_news_frequency",
        "age",
        "age_group",
        "name",
    ]
    assert rows(written["customers"]) == [
        ("c1", "1", "ACTIVE", "Never", 30, "Millennials"),
        ("c2", "0", "ACTIVE", "Never", 30, "Millennials"),
        ("c3", "1", "X", "Y", 80, "Silent"),
    ]
    assert rows(written["articles"]) == [(1, "a"), (2, "b")]
    assert rows(written["transactions"].select("customer_id", "sales_channel_id", "month")) == [
        ("c1", 2, "September"),
        ("c2", 2, "September"),
        ("c3", 1, None),
        ("c9", 2, "September"),
    ]
    assert rows(written["warehouse"].select("customer_id", "article_id")) == [("c1", 1), ("c2", 2), ("c3", 1)]


def test_save_modes(spark, jobs):
    """The dimensions are replaced, the warehouse grows, transactions depend on the feed."""
    run_historic(spark, jobs, "2024-01-31")
    assert counts(spark, jobs) == {"warehouse": 3, "customers": 3, "articles": 2, "transactions": 4}
    run_historic(spark, jobs, "2024-02-01")
    assert counts(spark, jobs) == {"warehouse": 6, "customers": 3, "articles": 2, "transactions": 4}
    run_live(spark, jobs, "2024-02-01")
    assert counts(spark, jobs) == {"warehouse": 8, "customers": 3, "articles": 2, "transactions": 6}
    run_live(spark, jobs, "2024-02-01")
    assert counts(spark, jobs) == {"warehouse": 10, "customers": 3, "articles": 2, "transactions": 8}


def test_historic_dimensions_are_extracted_once_a_day(spark, jobs):
    plans.extract_historic_dimensions(spark, jobs, "2024-01-31")
    with pytest.raises(AnalysisException):
        plans.extract_historic_dimensions(spark, jobs, "2024-01-31")
    plans.extract_historic_transactions(spark, jobs, "2024-01-31")
    plans.extract_historic_transactions(spark, jobs, "2024-01-31")
    assert spark.read.parquet(f"{feed_path(jobs.lake, 'Transactions', 'historic')}/2024-01-31").count() == 4


def test_live_snapshots_are_replaced_or_appended(spark, jobs):
    plans.extract_live(spark, jobs, "2024-01-31")
    plans.extract_live(spark, jobs, "2024-01-31")
    size = {
        entity: spark.read.parquet(f"{feed_path(jobs.lake, entity, 'Live')}/2024-01-31").count()
        for entity in plans.ENTITIES
    }
    assert size == {"Customers": 3, "Articles": 2, "Transactions": 4}


@pytest.mark.parametrize(
    "options", [{"join_strategy": "shuffle"}, {"max_broadcast_bytes": 0}, {"fact_partitions": 8, "n_files": 1}]
)
def test_layout_and_join_options_change_no_row(spark, jobs, tmp_path, options):
    run_historic(spark, jobs, "2024-01-31")
    other = dataclasses.replace(
        jobs, lake=f"{jobs.lake}-2", warehouse=Warehouse("parquet", {"path": str(tmp_path / "tables-2")}), **options
    )
    run_historic(spark, other, "2024-01-31")
    expected, result = tables(spark, jobs), tables(spark, other)
    assert all(rows(result[name]) == rows(expected[name]) for name in expected)


def test_facts_are_joined_before_they_are_cleaned(spark, jobs, monkeypatch):
    """So that only the snapshot's columns are shuffled; the warehouse has the columns of a join of cleaned facts."""
    joined, join = [], plans.star_join
    monkeypatch.setattr(plans, "star_join", lambda facts, *args: joined.append(facts.columns) or join(facts, *args))
    run_historic(spark, jobs, "2024-01-31")
    assert joined == [["t_dat", "customer_id", "article_id", "sales_channel_id"]]
    written = tables(spark, jobs)
    cleaned = [written["customers"], written["articles"], written["transactions"]]
    expected = join(cleaned[2], [(cleaned[0], "customer_id"), (cleaned[1], "article_id")])
    assert written["warehouse"].columns == expected.columns and rows(written["warehouse"]) == rows(expected)


def test_fills_come_from_the_feed_alone(spark, jobs):
    run_historic(spark, jobs, "2024-01-31")
    run_live(spark, jobs, "2024-01-31")
    live = tables(spark, jobs)["transactions"].where(F.year("t_dat") == 2020)
    assert rows(live.select("customer_id", "sales_channel_id")) == [("c1", 1), ("c2", 1)]


def test_snapshot_date_defaults_to_today(spark, jobs):
    plans.extract_live(spark, jobs)
    today = spark.sql("SELECT CAST(current_date() AS STRING)").first()[0]
    assert os.listdir(feed_path(jobs.lake, "Customers", "Live")) == [today]


def test_load_without_snapshots(spark, jobs):
    with pytest.raises(FileNotFoundError):
        plans.load_live(spark, jobs)


def test_frames_are_released_after_a_load(spark, jobs):
    run_historic(spark, jobs, "2024-01-31")
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()

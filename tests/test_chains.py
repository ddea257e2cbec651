"""Incremental extracts, and chains that are taken up again."""

import dataclasses
import datetime
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from retailweave.plans import jobs as plans
from retailweave.plans.jobs import run_historic, run_live
from retailweave.plans.steps import FileTarget, Ledger, UnknownTarget
from retailweave.plans.watermarks import Watermark, extract_new, store_of
from retailweave.sinks import commits
from retailweave.sinks.commits import log_of
from retailweave.sinks.writers import Warehouse
from retailweave.sources.snapshots import read_newest

from conftest import rows
from test_jobs import counts, jobs, tables  # noqa: F401


def day(n):
    return datetime.date(2024, 1, n)


SCHEMA = "d date, k int"


class Source:
    """A source table of files that rows are added to."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)

    def add(self, *rows):
        self.spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        return self.spark.read.schema(SCHEMA).parquet(self.path)


def taken(spark, root):
    return Counter(tuple(row) for row in read_newest(spark, root, "folder").collect())


def test_extracts_take_every_row_once(spark, tmp_path):
    source, root, mark = Source(spark, tmp_path / "s"), str(tmp_path / "lake"), Watermark("d")
    added = [
        [(day(1), 1), (day(2), 2), (day(2), 2), (None, 9)],
        [(day(2), 2), (day(2), 3), (day(3), 4), (None, 9), (None, 8)],  # late ones on the last day, equal to earlier rows and not
        [],
        [(day(3), 4), (day(7), 5)],
    ]
    seen = Counter()
    for part in added:
        commit = extract_new(source.add(*part), root, "2024-01-31", mark)
        seen.update(part)
        assert commit.n_rows == len(part) and taken(spark, root) == seen
    assert store_of(spark, root).last()["value"] == "2024-01-07"


def test_late_rows_within_the_overlap_are_found(spark, tmp_path):
    source, root = Source(spark, tmp_path / "s"), str(tmp_path / "lake")
    mark = Watermark("d", "INTERVAL 2 DAYS")
    extract_new(source.add((day(1), 1), (day(10), 2)), root, "x", mark)
    commit = extract_new(source.add((day(8), 3), (day(7), 4), (day(11), 5), (day(10), 2)), root, "x", mark)
    assert commit.n_rows == 3  # the row of the 7th is too late
    assert taken(spark, root) == Counter({(day(1), 1): 1, (day(10), 2): 2, (day(8), 3): 1, (day(11), 5): 1})


def test_the_watermark_is_pushed_into_the_source(spark, tmp_path, plan):
    from retailweave.plans.watermarks import _advanced, new_rows

    source, root, mark = Source(spark, tmp_path / "s"), str(tmp_path / "lake"), Watermark("d")
    df = source.add((day(1), 1), (day(5), 2))
    extract_new(df, root, "x", mark)
    text = plan(new_rows(df, spark, _advanced(spark, root, mark, df), mark), "formatted")
    assert "PushedFilters: [IsNotNull(d), GreaterThan(d,2024-01-05)]" in text
    assert "Or(And(GreaterThanOrEqual(d,2024-01-05),LessThanOrEqual(d,2024-01-05)),IsNull(d))" in text.replace("\n", "")


def test_a_commit_that_the_store_missed_is_taken_in(spark, tmp_path, monkeypatch):
    source, root, mark = Source(spark, tmp_path / "s"), str(tmp_path / "lake"), Watermark("d")
    df = source.add((day(1), 1), (day(2), 2))
    monkeypatch.setattr("retailweave.plans.watermarks._after", lambda *_: (_ for _ in ()).throw(InterruptedError()))
    with pytest.raises(InterruptedError):
        extract_new(df, root, "x", mark)
    monkeypatch.undo()
    assert store_of(spark, root).last() is None and len(log_of(spark, root).names()) == 1
    assert extract_new(df, root, "x", mark).n_rows == 0
    assert taken(spark, root) == Counter({(day(1), 1): 1, (day(2), 2): 1})


def test_rows_without_any_value(spark, tmp_path):
    source, root, mark = Source(spark, tmp_path / "s"), str(tmp_path / "lake"), Watermark("d")
    assert extract_new(source.add((None, 1)), root, "x", mark).n_rows == 1
    assert extract_new(source.add((None, 1), (None, 2)), root, "x", mark).n_rows == 2
    assert extract_new(source.add((day(1), 1)), root, "x", mark).n_rows == 1
    assert extract_new(source.add(), root, "x", mark).n_rows == 0


# ---- jobs --------------------------------------------------------------------


def test_repeated_live_runs_add_nothing(spark, jobs):  # noqa: F811
    keys = {"transactions": ["t_dat", "customer_id", "article_id"], "warehouse": ["t_dat", "customer_id", "article_id"]}
    safe = dataclasses.replace(jobs, append_keys=keys, append_within={"transactions": "t_dat"})
    run_historic(spark, safe, "2024-01-31")
    for date in ("2024-02-01", "2024-02-01", "2024-02-02"):
        run_live(spark, safe, date)
    assert counts(spark, safe) == {"warehouse": 5, "customers": 3, "articles": 2, "transactions": 6}


def test_incremental_live_runs_load_what_is_new(spark, jobs):  # noqa: F811
    live = jobs.sources[plans.LIVE]
    first = dataclasses.replace(jobs, commits=True, ledger=f"{jobs.lake}/ledger", watermarks={"Transactions": Watermark("t_dat")})
    run_historic(spark, first, "2024-01-31")
    run_live(spark, first, "2024-02-01")
    assert counts(spark, first) == {"warehouse": 5, "customers": 3, "articles": 2, "transactions": 6}
    run_live(spark, first, "2024-02-01")
    assert counts(spark, first) == {"warehouse": 5, "customers": 3, "articles": 2, "transactions": 6}
    grown = live["Transactions"](spark).union(spark.createDataFrame([("2020-01-03", "c1", 2, 1)], live["Transactions"](spark).schema))
    later = dataclasses.replace(first, sources={plans.LIVE: live | {"Transactions": lambda _: grown}})
    # Two extracts before the next load: it takes both.
    plans.extract_live(spark, later, "2024-02-02")
    plans.extract_live(spark, later, "2024-02-03")
    plans.load_live(spark, later)
    assert counts(spark, later) == {"warehouse": 6, "customers": 3, "articles": 2, "transactions": 7}
    with pytest.raises(ValueError, match="ledger"):
        dataclasses.replace(jobs, watermarks={"Transactions": Watermark("t_dat")})


STEPS = ("extract-Customers", "extract-Articles", "extract-Transactions", "load-customers", "load-articles", "load-warehouse", "load-transactions")


@pytest.mark.parametrize("options", [{}, {"commits": True}], ids=["plain", "committed"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_chain_that_broke_resumes_to_the_same_tables(spark, jobs, tmp_path, monkeypatch, when, options):  # noqa: F811
    """Broken once in every step, before or after it wrote."""
    run_historic(spark, jobs, "2024-01-31")
    run_live(spark, jobs, "2024-02-01")
    expected = {name: rows(df) for name, df in tables(spark, jobs).items()}
    other = dataclasses.replace(
        jobs, lake=str(tmp_path / "lake-2"), warehouse=Warehouse("parquet", {"path": str(tmp_path / "tables-2")}), ledger=str(tmp_path / "ledger"), **options
    )
    broken, run = set(), Ledger.run

    def breaking(self, name, action, target=None):
        def acting():
            key = (self._records.path, name)
            if key in broken:
                return action()
            broken.add(key)
            if when == "after":
                action()
            raise InterruptedError(name)

        return run(self, name, acting, target)

    monkeypatch.setattr(Ledger, "run", breaking)
    for chain, date in ((run_historic, "2024-01-31"), (run_live, "2024-02-01")):
        times = 0
        while True:
            try:
                chain(spark, other, date)
                break
            except InterruptedError:
                times += 1
        # A committed snapshot is complete although its step broke off after it.
        assert times == len(STEPS)
    assert {name: rows(df) for name, df in tables(spark, other).items()} == expected
    monkeypatch.undo()
    run_live(spark, other, "2024-02-01")  # a new run, since the last one was finished
    assert counts(spark, other)["transactions"] == len(expected["transactions"]) + 2


def test_a_broken_append_that_cannot_be_taken_back_is_told(spark, tmp_path):
    def fail():
        raise InterruptedError

    path = str(tmp_path / "chain")
    with pytest.raises(InterruptedError):
        Ledger(spark, path).run("load", fail, UnknownTarget("sales", "append", repeatable=False))
    with pytest.raises(RuntimeError, match="sales"):
        Ledger(spark, path).run("load", fail, UnknownTarget("sales", "append", repeatable=False))
    Ledger(spark, path).run("load", lambda: None, UnknownTarget("sales", "append", repeatable=True))
    assert Ledger(spark, path).resumed


def test_files_of_a_broken_append_are_taken_back(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    target = FileTarget(spark, path, "append")
    state = target.state()
    spark.range(4).write.mode("append").parquet(path)
    assert target.restore(state) is False and spark.read.parquet(path).count() == 3
    assert not [name for name in os.listdir(path) if commits.discard(spark, path, set(state["writes"]))]


# ---- staged replacement --------------------------------------------------------


def test_a_failing_replacement_leaves_the_old_table(spark, tmp_path):
    target = Warehouse("parquet", {"path": str(tmp_path)}, staged=True)
    target.write(spark.range(3), "t", "overwrite")
    with pytest.raises(Exception, match="broken"):
        target.write(spark.range(9).select(F.when(F.col("id") > 7, F.raise_error(F.lit("broken"))).cast("long").alias("id")), "t", "overwrite")
    assert target.read(spark, "t").count() == 3
    target.write(target.read(spark, "t").where("id > 0"), "t", "overwrite")  # from itself
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == [(1,), (2,)]
    assert not os.path.exists(tmp_path / "_replaced" / "t") and os.listdir(tmp_path / "_staged") == []
    target.write(spark.range(2), "t", "append")
    assert target.read(spark, "t").count() == 4


def test_a_replacement_that_broke_between_its_moves_is_taken_back(spark, tmp_path):
    target = Warehouse("parquet", {"path": str(tmp_path)}, staged=True)
    target.write(spark.range(3), "t", "overwrite")
    os.makedirs(tmp_path / "_replaced" / "t")
    os.rename(tmp_path / "t", tmp_path / "_replaced" / "t" / "0")
    assert target.read(spark, "t").count() == 3
    os.makedirs(tmp_path / "_replaced" / "t")
    os.rename(tmp_path / "t", tmp_path / "_replaced" / "t" / "1")
    target.write(spark.range(1), "t", "append")
    assert target.read(spark, "t").count() == 4


def test_catalog_tables_are_replaced_whole(spark):
    target = Warehouse("catalog", staged=True)
    try:
        target.write(spark.range(3), "staged_test", "overwrite")
        with pytest.raises(Exception, match="broken"):
            target.write(spark.range(2).select(F.raise_error(F.lit("broken")).alias("id")), "staged_test", "overwrite")
        target.write(target.read(spark, "staged_test").where("id > 0"), "staged_test", "overwrite")
        assert rows(spark.table("staged_test")) == [(1,), (2,)]
        assert [t.name for t in spark.catalog.listTables() if t.name.startswith("staged_test")] == ["staged_test"]
    finally:
        spark.sql("DROP TABLE IF EXISTS staged_test")
    with pytest.raises(ValueError, match="staged"):
        Warehouse("jdbc", staged=True)

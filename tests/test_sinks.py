import os
import tempfile
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException

from retailweave.sinks import writers
from retailweave.sinks.scratch import run_folder, work_folder, written
from retailweave.sinks.writers import Warehouse, spread, write_snapshot

from conftest import rows


def test_default_snapshot_mode_refuses_an_existing_folder(spark, tmp_path):
    path = str(tmp_path / "s")
    write_snapshot(spark.range(3), path)
    with pytest.raises(AnalysisException) as error:
        write_snapshot(spark.range(3), path)
    assert error.value.getCondition() == "PATH_ALREADY_EXISTS"


@pytest.mark.parametrize("mode, count", [("overwrite", 5), ("append", 8)])
def test_snapshot_modes(spark, tmp_path, mode, count):
    path = str(tmp_path / "s")
    write_snapshot(spark.range(3), path, mode)
    write_snapshot(spark.range(5), path, mode)
    assert spark.read.parquet(path).count() == count


def test_number_of_files(spark, tmp_path, plan):
    df = spark.range(0, 1000, 1, 4)
    for n_files, expected in ((None, 4), (1, 1), (6, 6)):
        path = tmp_path / f"s{n_files}"
        write_snapshot(df, str(path), n_files=n_files)
        assert len(list(path.glob("*.parquet"))) == expected
    assert "Exchange" not in plan(spread(df, None))
    assert "RoundRobinPartitioning(8)" in plan(spread(df, 8))


def test_large_snapshots_get_their_files_without_a_shuffle(spark, tmp_path, plan, monkeypatch):
    """As many files as asked, made of the splits of a table, and more where files would be too large."""
    monkeypatch.setattr(writers, "SHUFFLED_FILE_BYTES", 0)
    made, gathered = writers._gathered, []
    monkeypatch.setattr(writers, "_gathered", lambda *args: gathered.append(made(*args)) or gathered[-1])
    df = spark.range(0, 1000, 1, 16)
    write_snapshot(df, str(tmp_path / "s"), n_files=4)
    assert len(list((tmp_path / "s").glob("*.parquet"))) == 4
    assert "Exchange" not in plan(gathered[0]) and "Coalesce" in plan(gathered[0])
    monkeypatch.setattr(writers, "MAX_FILE_BYTES", 3000)
    write_snapshot(df, str(tmp_path / "t"), n_files=1)
    assert len(list((tmp_path / "t").glob("*.parquet"))) > 1
    assert rows(spark.read.parquet(str(tmp_path / "s"))) == rows(spark.read.parquet(str(tmp_path / "t"))) == rows(df)
    assert sorted(os.listdir(tmp_path)) == ["s", "t"]


@pytest.mark.parametrize("file_format", ["parquet", "orc", "json"])
def test_file_tables(spark, tmp_path, file_format):
    target = Warehouse(file_format, {"path": str(tmp_path)})
    for mode, count in (("overwrite", 3), ("append", 6), ("overwrite", 3)):
        target.write(spark.range(3), "t", mode)
        assert spark.read.format(file_format).load(str(tmp_path / "t")).count() == count


def test_catalog_tables(spark, tmp_path):
    target = Warehouse("catalog", {"path": str(tmp_path / "t")})
    try:
        target.write(spark.range(3), "sink_test", "append")
        target.write(spark.range(3), "sink_test", "append")
        assert rows(spark.table("sink_test")) == [(0,), (0,), (1,), (1,), (2,), (2,)]
        target.write(spark.range(1), "sink_test", "overwrite")
        assert rows(spark.table("sink_test")) == [(0,)]
    finally:
        spark.sql("DROP TABLE IF EXISTS sink_test")


class Recorder:
    """Stands in for a frame and its writer and records what it is told."""

    def __init__(self):
        self.write = self
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def options(self, **options):
        self.told.update(options)
        return self

    def option(self, name, value):
        return self.options(**{name: value})

    def mode(self, mode):
        self.told["mode"] = mode
        return self

    def save(self):
        self.told["saved"] = True


@pytest.mark.parametrize("connector", ["jdbc", "com.example.connector"])
def test_connectors_get_the_table_and_the_options(connector):
    df = Recorder()
    Warehouse(connector, {"url": "jdbc:x", "tempdir": "s3://t"}).write(df, "customers", "overwrite")
    assert df.told == {
        "format": connector,
        "url": "jdbc:x",
        "tempdir": "s3://t",
        "dbtable": "customers",
        "mode": "overwrite",
        "saved": True,
    }


def test_secrets_stay_out_of_the_repr():
    assert "secret" not in repr(Warehouse("jdbc", {"password": "secret"}))


# ---- work folders ------------------------------------------------------------


class Session:
    """A session of a master, with the settings given."""

    def __init__(self, master, **settings):
        self.sparkContext, self.conf = SimpleNamespace(master=master), settings


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]", "spark://h:7077", "local-cluster[3,2,1024]", "yarn"])
def test_work_folders_lie_in_the_shared_folder(master):
    session = Session(master, **{"spark.checkpoint.dir": "s3://shared/folder/"})
    first, second = work_folder(session), work_folder(session)
    assert first != second and first.startswith("s3://shared/folder/retailweave-")


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_a_local_master_may_use_a_temporary_folder(master):
    assert work_folder(Session(master)).startswith(tempfile.gettempdir())


@pytest.mark.parametrize("master", ["spark://h:7077", "local-cluster[3,2,1024]", "yarn", "k8s://h"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(Session(master))


def test_a_run_removes_its_own_files(spark):
    outside = written(spark.range(2))
    with run_folder(spark) as run:
        inside = written(spark.range(3))
        with run_folder(spark) as inner:
            assert written(spark.range(4)).count() == 4 and inner.startswith(run)
        assert inside.count() == 3 and all(file.startswith(f"file://{run.removeprefix('file://')}/") for file in inside.inputFiles())
        assert os.listdir(run.removeprefix("file://"))
    assert not os.path.exists(run.removeprefix("file://")) and outside.count() == 2
    with pytest.raises(ZeroDivisionError), run_folder(spark) as run:
        written(spark.range(3))
        1 / 0
    assert not os.path.exists(run.removeprefix("file://"))
    assert not work_folder(spark).startswith(run)

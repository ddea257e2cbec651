import datetime
import os
import re
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailweave.sinks.writers import write_snapshot
from retailweave.sources import snapshots, tables
from retailweave.sources.snapshots import feed_path, newest_file, read_newest, run_date

from conftest import rows


def data_files(folder):
    return sorted(
        os.path.join(path, name) for path, _, names in os.walk(folder) for name in names if name.endswith(".parquet")
    )


def set_time(files, seconds):
    for file in files:
        os.utime(file, (seconds, seconds))


# ---- tables ------------------------------------------------------------------


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("t_dat,article_id,sales_channel_id\n2018-09-20,0663713001,2\n2018-09-21,0541518023,\n")
    return str(path)


def test_csv_with_inferred_types(spark, csv):
    df = tables.read_csv(spark, csv)
    assert df.dtypes == [("t_dat", "date"), ("article_id", "int"), ("sales_channel_id", "int")]
    assert rows(df)[0] == (datetime.date(2018, 9, 20), 663713001, 2)


def test_csv_with_a_schema_keeps_the_text(spark, csv, plan):
    df = tables.read_csv(spark, csv, "t_dat STRING, article_id STRING, sales_channel_id INT")
    assert rows(df) == [("2018-09-20", "0663713001", 2), ("2018-09-21", "0541518023", None)]
    assert "ReadSchema: struct<article_id:string>" in plan(df.select("article_id"), "formatted")


class FakeJdbc:
    """Stands in for the session: records the options of each read and answers from frames."""

    def __init__(self, spark, table, ends):
        self.spark, self.table, self.ends = spark, table, ends
        self.reads = []
        self.read = self

    def format(self, name):
        assert name == "jdbc"
        self.current = {}
        return self

    def options(self, **options):
        self.current.update(options)
        return self

    def jdbc(self, url, table, predicates, properties):
        self.reads.append({"url": url, "table": table, "predicates": predicates, "properties": properties})
        return self.table

    def load(self):
        self.reads.append(self.current)
        return self.ends if "query" in self.current else self.table


def fake(spark, schema, low=None, high=None, ends_schema="low int, high int"):
    return FakeJdbc(spark, spark.createDataFrame([], schema), spark.createDataFrame([(low, high)], ends_schema))


ACCESS = {"user": "u", "password": "p"}


CUSTOMERS = "customer_id string, FN double, Active double, age int"


def test_jdbc_without_a_column_is_one_connection(spark):
    """No column is guessed: ages come in few values and end dates in a far one."""
    for schema in (CUSTOMERS, "id int, valid_to date", "name string"):
        source = fake(spark, schema)
        tables.read_jdbc(source, "jdbc:x", "customers", **ACCESS)
        assert source.reads == [{"url": "jdbc:x", "dbtable": "customers", **ACCESS}]


def test_jdbc_reads_ranges_of_a_given_column(spark):
    day = datetime.date(2018, 9, 20)
    source = fake(spark, "n int, d date", day, datetime.date(9999, 12, 31), ends_schema="LOW date, HIGH date")
    tables.read_jdbc(source, "jdbc:x", "sales", partition_column="d", num_partitions=7, **ACCESS)
    assert [read.get("query") for read in source.reads] == ['SELECT MIN("d") AS low, MAX("d") AS high FROM sales', None]
    assert source.reads[-1] == {
        "url": "jdbc:x",
        "dbtable": "sales",
        "partitionColumn": "d",
        "lowerBound": "2018-09-20",
        "upperBound": "9999-12-31",
        "numPartitions": "7",
        **ACCESS,
    }


@pytest.mark.parametrize(
    "url, name, quoted",
    [
        ("jdbc:postgresql://h/d", 'a"b', '"a""b"'),
        ("jdbc:mysql://h/d", "order", "`order`"),
        ("jdbc:mariadb://h/d", "a`b", "`a``b`"),
    ],
)
def test_jdbc_names_are_quoted(spark, url, name, quoted):
    source = fake(spark, "n int", 1, 5)
    tables.read_jdbc(source, url, "sales", partition_column=name)
    assert source.reads[0]["query"] == f"SELECT MIN({quoted}) AS low, MAX({quoted}) AS high FROM sales"
    assert source.reads[-1]["partitionColumn"] == name
    assert source.reads[-1]["numPartitions"] == str(tables.JDBC_PARTITIONS)


def test_jdbc_reads_by_predicates(spark):
    source = fake(spark, "n int")
    tables.read_jdbc(source, "jdbc:x", "sales", predicates=["n < 5", "n >= 5 OR n IS NULL"], **ACCESS)
    assert source.reads == [{"url": "jdbc:x", "table": "sales", "predicates": ["n < 5", "n >= 5 OR n IS NULL"], "properties": ACCESS}]
    with pytest.raises(ValueError, match="either"):
        tables.read_jdbc(source, "jdbc:x", "sales", partition_column="n", predicates=["n < 5"])


@pytest.mark.parametrize(
    "schema, low, high, bounds",
    [
        ("LOW bigint, HIGH bigint", 1, 9, ("1", "9")),
        ("LOW decimal(38,10), HIGH decimal(38,10)", Decimal("1.5"), Decimal("8.2"), ("1", "9")),
        ("LOW decimal(10,2), HIGH decimal(10,2)", Decimal("-1.5"), Decimal("-0.5"), ("-2", "0")),
        ("LOW double, HIGH double", -1.5, 2.5, ("-2", "3")),
        ("LOW timestamp, HIGH timestamp", datetime.datetime(2020, 1, 1), datetime.datetime(2020, 1, 2, 3), ("2020-01-01 00:00:00", "2020-01-02 03:00:00")),
    ],
)
def test_jdbc_bounds_are_whole_numbers_around_the_rows(spark, schema, low, high, bounds):
    ends = spark.createDataFrame([(low, high)], schema).select(
        *(F.to_utc_timestamp(c, time.tzname[0]).alias(c) if "timestamp" in schema else c for c in ("LOW", "HIGH"))
    )
    source = FakeJdbc(spark, spark.createDataFrame([], "k int"), ends)
    tables.read_jdbc(source, "jdbc:x", "sales", partition_column="k")
    assert (source.reads[-1]["lowerBound"], source.reads[-1]["upperBound"]) == bounds


@pytest.mark.parametrize(
    "schema, low, high",
    [("low double, high double", 1.0, float("nan")), ("low double, high double", -float("inf"), 2.0), ("low decimal(38,0), high decimal(38,0)", Decimal(1), Decimal(10) ** 30)],
)
def test_jdbc_bounds_beyond_64_bits_are_read_at_once(spark, schema, low, high):
    source = fake(spark, "k double", low, high, schema)
    tables.read_jdbc(source, "jdbc:x", "sales", partition_column="k", **ACCESS)
    assert source.reads[-1] == {"url": "jdbc:x", "dbtable": "sales", **ACCESS}


def keys(spark, kind):
    """Keys of a type, a third of them one value, with repeats and nulls."""
    number = F.when(F.col("id") % 3 == 0, 500).otherwise(F.pow(F.col("id") / 100, F.lit(3)))
    made = {
        "int": number.cast("int"),
        "decimal(38,10)": (number / 7).cast("decimal(38,10)"),
        "double": F.when(F.col("id") == 5, float("nan")).when(F.col("id") == 7, float("inf")).otherwise(-number / 7),
        "date": F.date_add(F.lit("1990-01-01").cast("date"), number.cast("int")),
        "timestamp": F.timestamp_micros((number * 1_234_567).cast("long")),
        "timestamp_ntz": F.timestamp_micros((number * 1_234_567).cast("long")).cast("timestamp_ntz"),
    }[kind]
    return spark.range(3000).select("id", F.when(F.col("id") % 50 != 0, made).alias("the key"))


@pytest.mark.parametrize("kind", ["int", "decimal(38,10)", "double", "date", "timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("n", [1, 2, 9])
def test_even_predicates_take_every_row_once(spark, kind, n):
    table = keys(spark, kind)
    parts = tables.even_predicates(table.where("id % 2 = 0"), "the key", n, "jdbc:mysql://h/d")
    found = table.select(*(F.coalesce(F.expr(part).cast("int"), F.lit(0)).alias(str(i)) for i, part in enumerate(parts)))
    times = found.select(sum(F.col(name) for name in found.columns).alias("n")).distinct().collect()
    assert [row.n for row in times] == [1] and len(parts) <= n + 1
    sizes = sorted(found.agg(*(F.sum(name) for name in found.columns)).first(), reverse=True)
    # The one frequent value is a part of its own, and the others are even.
    assert n < 3 or (sizes[0] < 1100 and sizes[1] < 2 * 3000 / n)


def test_a_sample_makes_the_predicates_of_a_read(spark):
    source = fake(spark, "k int")
    tables.read_jdbc(source, "jdbc:x", "sales", partition_column="k", num_partitions=2, sample=spark.createDataFrame([(1,), (2,), (3,), (4,)], "k int"))
    assert source.reads[0]["predicates"] == ['"k" < 2 OR "k" IS NULL', '"k" >= 2']
    assert tables.even_predicates(spark.createDataFrame([(None,)], "k int"), "k", 5, "jdbc:x") == ["1 = 1"]
    with pytest.raises(ValueError, match="order"):
        tables.even_predicates(spark.createDataFrame([], "k string"), "k", 5, "jdbc:x")
    with pytest.raises(ValueError, match="partition column"):
        tables.read_jdbc(source, "jdbc:x", "sales", sample=source.table)


@pytest.mark.parametrize("options", [{"num_partitions": 1}, {}], ids=["one partition asked", "empty table"])
def test_jdbc_reads_at_once(spark, options):
    source = fake(spark, "n int", None, None)
    tables.read_jdbc(source, "jdbc:x", "sales", partition_column="n", **options, **ACCESS)
    assert source.reads[-1] == {"url": "jdbc:x", "dbtable": "sales", **ACCESS}


# ---- snapshots ---------------------------------------------------------------


def test_run_date(spark):
    assert run_date(spark, "2024-01-31") == "2024-01-31"
    assert re.fullmatch(r"\d{4}-\d\d-\d\d", run_date(spark))


def test_feed_path():
    assert feed_path("s3://lake/", "Customers", "Live") == "s3://lake/Customers/Customers_Live"


def test_newest_of_two_days(spark, tmp_path):
    root = str(tmp_path / "feed")
    write_snapshot(spark.range(3), f"{root}/2024-01-31", n_files=1)
    write_snapshot(spark.range(5), f"{root}/2024-02-01", n_files=1)
    older, newer = data_files(f"{root}/2024-02-01"), data_files(f"{root}/2024-01-31")
    set_time(older, 1_000)
    set_time(newer, 2_000)
    # The time of writing decides, not the folder's date.
    assert read_newest(spark, root).count() == 3
    set_time(older, 3_000)
    assert read_newest(spark, root).count() == 5


def test_snapshot_of_many_files_is_read_whole(spark, tmp_path):
    root = str(tmp_path / "feed")
    write_snapshot(spark.range(100), f"{root}/2024-01-31", n_files=5)
    assert len(data_files(root)) == 5
    assert read_newest(spark, root).count() == 100
    # Round-robin, so about twenty rows in the one file.
    assert 0 < read_newest(spark, root, "file").count() < 100


def test_earlier_appends_are_left_out(spark, tmp_path):
    root = str(tmp_path / "feed")
    write_snapshot(spark.range(100), f"{root}/2024-01-31", "append", n_files=3)
    set_time(data_files(root), 1_000)
    write_snapshot(spark.range(40), f"{root}/2024-01-31", "append", n_files=2)
    assert read_newest(spark, root).count() == 40
    assert read_newest(spark, root, "folder").count() == 140


def test_equal_times_go_to_the_smallest_path(spark, tmp_path):
    root = str(tmp_path / "feed")
    write_snapshot(spark.range(3), f"{root}/a", n_files=1)
    write_snapshot(spark.range(5), f"{root}/b", n_files=1)
    set_time(data_files(root), 5_000)
    assert newest_file(spark, root).path.endswith(data_files(root)[0])


def test_files_of_other_writers_are_read_alone(spark, tmp_path):
    root = tmp_path / "feed"
    root.mkdir()
    spark.range(4).toPandas().to_parquet(root / "export.parquet")
    assert read_newest(spark, str(root)).count() == 4


def test_several_files_of_other_writers_are_an_error(spark, tmp_path):
    root = tmp_path / "feed" / "2024-01-31"
    root.mkdir(parents=True)
    for i in range(3):
        spark.range(10).toPandas().to_parquet(root / f"export-{i}.parquet")
    with pytest.raises(ValueError, match='scope="file" or all with scope="folder"'):
        read_newest(spark, str(tmp_path / "feed"))
    assert read_newest(spark, str(tmp_path / "feed"), "file").count() == 10
    assert read_newest(spark, str(tmp_path / "feed"), "folder").count() == 30


def test_files_of_early_dates_are_not_listed(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "feed")
    for day in range(1, 10):
        write_snapshot(spark.range(day), f"{root}/2024-01-0{day}", n_files=1)
    listed = []
    real = snapshots._files
    monkeypatch.setattr(snapshots, "_files", lambda spark, paths: listed.extend(paths) or real(spark, paths))
    # Written again after all others, but too early a date.
    set_time(data_files(f"{root}/2024-01-01"), 4e9)
    set_time(data_files(f"{root}/2024-01-07"), 3e9)
    assert read_newest(spark, root, days=3).count() == 7
    assert sorted(os.path.basename(path) for path in listed) == ["2024-01-07", "2024-01-08", "2024-01-09"]
    assert read_newest(spark, root, days=9).count() == 1
    assert read_newest(spark, root, days=None).count() == 1


def test_markers_do_not_count(spark, tmp_path):
    root = str(tmp_path / "feed")
    write_snapshot(spark.range(3), f"{root}/2024-01-31")
    os.utime(f"{root}/2024-01-31/_SUCCESS", (4e9, 4e9))
    assert read_newest(spark, root).count() == 3


def test_unfinished_writes_do_not_count(spark, tmp_path):
    write_snapshot(spark.range(3), str(tmp_path / "2024-01-31"))
    set_time(data_files(tmp_path), 1_000)
    spark.range(5).write.parquet(str(tmp_path / "2024-01-31" / "_temporary" / "0"))
    assert read_newest(spark, str(tmp_path)).count() == 3


@pytest.mark.parametrize("exists", [True, False])
def test_no_snapshot(spark, tmp_path, exists):
    root = tmp_path / "feed"
    if exists:
        root.mkdir()
    with pytest.raises(FileNotFoundError, match="no Parquet snapshot"):
        newest_file(spark, str(root))


def test_unknown_scope(spark, tmp_path):
    write_snapshot(spark.range(3), str(tmp_path / "a"))
    with pytest.raises(ValueError, match="scope"):
        read_newest(spark, str(tmp_path), "day")


def test_search_leaves_the_session_alone(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    write_snapshot(spark.range(3), str(tmp_path / "a"))
    newest_file(spark, str(tmp_path))
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_only_used_columns_are_read(spark, tmp_path, plan):
    write_snapshot(spark.range(3).withColumn("x", F.lit(1)), str(tmp_path / "a"))
    assert "ReadSchema: struct<id:bigint>" in plan(read_newest(spark, str(tmp_path)).select("id"), "formatted")

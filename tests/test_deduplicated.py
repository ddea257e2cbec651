import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from retailweave.operators import joins
from retailweave.sinks.deduplicated import PARTS, LoadLedger, append_new, missing_rows
from retailweave.sinks.writers import Warehouse

SCHEMA = "k int, s string, v double"


def counted(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.mark.parametrize("keys", [["k"], ["k", "s"], ["K", "S", "V"]])
def test_numbers_per_key_equal_brute_force(spark, keys):
    chance = random.Random(4)
    made = lambda n: [(chance.choice([None, 1, 2, 3]), chance.choice([None, "a", "b"]), chance.choice([None, 0.5, 1.5])) for _ in range(n)]
    batch, target = made(300), made(200)
    at = ["ksv".index(key.lower()) for key in keys]
    df = spark.createDataFrame(batch, SCHEMA).repartition(5)
    found = counted(missing_rows(df, spark.createDataFrame(target, SCHEMA).repartition(3), keys))
    have = Counter(tuple(row[i] for i in at) for row in target)
    want = Counter(tuple(row[i] for i in at) for row in batch)
    by_key = Counter()
    for row, n in found.items():
        by_key[tuple(row[i] for i in at)] += n
    assert by_key == want - have
    assert not found - Counter(batch)


def test_a_hot_key_is_numbered_in_parts(spark):
    """One key with most rows, all different, and a key whose rows are all equal."""
    df = spark.range(20_000).select(F.when(F.col("id") % 3 < 2, 1).otherwise(2).alias("k"), F.when(F.col("id") % 3 < 2, F.col("id")).alias("v"))
    target = df.sample(0.3, 3).persist()
    try:
        missing = missing_rows(df, target, ["k"])
        assert dict(missing.groupBy("k").count().collect()) == {
            k: n - dict(target.groupBy("k").count().collect())[k] for k, n in df.groupBy("k").count().collect()
        }
    finally:
        target.unpersist()
    plan = missing._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_rows_are_shuffled_once(spark, plan):
    """The batch's rows and the target's numbers of them."""
    df = spark.range(500).selectExpr("id AS k", "'x' AS s", "1.0D AS v")
    text = plan(missing_rows(df, df.where("k % 3 = 0"), ["k", "s"]))
    assert text.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("hot_rows", [1, 10**9])
def test_hot_keys_leave_out_the_same_rows(spark, monkeypatch, hot_rows):
    """By the order of parts and hashes, whatever counts as hot."""
    monkeypatch.setattr(joins, "HOT_ROWS", hot_rows)
    df = spark.range(3000).selectExpr("IF(id % 2 = 0, 7L, id % 40) AS k", "CAST(id % 300 AS STRING) AS s", "id % 11 AS v").repartition(4)
    target = df.where("v < 5").repartition(3)
    row = F.xxhash64("k", "s", "v")
    order = W.partitionBy("k").orderBy(F.pmod(F.xxhash64(F.lit(1), row), F.lit(PARTS)), row)
    held = target.groupBy(F.col("k").alias("of")).count()
    expected = df.withColumn("nth", F.row_number().over(order)).join(held, F.col("k") == F.col("of"), "left").where("nth > coalesce(count, 0)")
    assert counted(missing_rows(df, target, ["k"])) == counted(expected.select("k", "s", "v"))


def test_the_target_is_read_within_the_batch(spark, tmp_path, plan):
    spark.range(1000).selectExpr("id AS k", "'x' AS s", "1.0D AS v").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    batch = spark.createDataFrame([(998, "x", 1.0), (1005, "x", 1.0)], SCHEMA)
    found = missing_rows(batch, target, ["k"], within="k")
    text = plan(found, "formatted")
    assert "GreaterThanOrEqual(k,998)" in text and "LessThanOrEqual(k,1005)" in text and "ReadSchema: struct<k:bigint>" in text
    assert counted(found) == Counter({(1005, "x", 1.0): 1})
    with pytest.raises(ValueError, match="no key"):
        missing_rows(batch, target, ["k"], within="v")


def test_nulls_empty_frames_and_unknown_keys(spark):
    df = spark.createDataFrame([(None, None, None), (None, None, None)], SCHEMA)
    nothing = df.limit(0)
    assert counted(missing_rows(df, df.limit(1), ["k", "s", "v"], within="k")) == Counter({(None, None, None): 1})
    assert counted(missing_rows(df, nothing, ["k"])) == counted(df)
    assert counted(missing_rows(nothing, df, ["k"], within="k")) == Counter()
    with pytest.raises(ValueError, match="nope"):
        missing_rows(df, df, ["nope"])
    with pytest.raises(ValueError, match="none given"):
        missing_rows(df, df, [])


@pytest.mark.parametrize("file_format", ["parquet", "orc", "json", "catalog"])
def test_a_load_is_appended_once(spark, tmp_path, file_format):
    target = Warehouse(file_format, {"path": str(tmp_path / "t")})
    ledger = LoadLedger(spark, str(tmp_path / "loads"))
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0), (2, None, 2.0)], SCHEMA)
    keys = ["k", "s"]
    try:
        assert append_new(target, df.limit(2), "dedup_test", keys) == 2  # part of a load that broke off
        assert append_new(target, df, "dedup_test", keys, ledger=ledger, load_id="a/1") == 1
        assert append_new(target, df, "dedup_test", keys, ledger=ledger, load_id="a/1") == 0
        assert append_new(target, df, "dedup_test", keys, ledger=ledger, load_id="a/2") == 0
        assert counted(target.read(spark, "dedup_test").select("k", "s", "v")) == counted(df)
        assert ledger.has("dedup_test", "a/1") and not ledger.has("dedup_test", "b") and not ledger.has("other", "a/1")
        assert [ledger.listed(table)(load) for table, load in (("dedup_test", "a/1"), ("dedup_test", "b"), ("other", "a/1"))] == [True, False, False]
    finally:
        spark.sql("DROP TABLE IF EXISTS dedup_test")


def test_a_listed_load_is_not_read_again(spark, tmp_path):
    target, ledger = Warehouse("parquet", {"path": str(tmp_path / "t")}), LoadLedger(spark, str(tmp_path / "loads"))
    broken = spark.range(3).select(F.raise_error(F.lit("read")).cast("int").alias("k"))
    ledger.finished("t", "x", 3)
    assert append_new(target, broken, "t", ["k"], ledger=ledger, load_id="x") == 0
    with pytest.raises(Exception, match="read"):
        append_new(target, broken, "t", ["k"], ledger=ledger, load_id="y")
    assert not ledger.has("t", "y")
    with pytest.raises(ValueError, match="together"):
        append_new(target, broken, "t", ["k"], load_id="y")

"""Fact and dimension tables in buckets of their join key, joined without a shuffle.

Both tables are cut into the same number of buckets by a hash of the key and sorted within them, once, when they are
written. A join then merges bucket by bucket. A bucket is one task, so keys that hold more than an average bucket would be a
task each. When they are written, their rows go to tasks of their own, several for a key, and so to files of their own. When they
are joined, they are taken out of the merge, by a filter on the same scan that passes over those files by their statistics, and
joined on their own with the few dimension rows of those keys.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailweave.operators.joins import PARTS_PER_PARTITION, hot_keys, star_join


def write_bucketed(df: DataFrame, table: str, key: str, n_buckets: int, path: str | None = None) -> None:
    """A catalog table of one sorted file for each bucket of ``key``, which replaces the table of that name.

    A key with half as many rows as an average bucket and more has sorted files of its own besides, of fewer rows each.
    """
    writer = _dealt(df, key, n_buckets).write.format("parquet").mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(n_buckets, key).sortBy(key).saveAsTable(table)


def _dealt(df: DataFrame, key: str, n_buckets: int) -> DataFrame:
    """One task for each bucket, and several for each key that would make one task long."""
    hashed = F.xxhash64(_quoted(key))
    average = PARTS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = {value: ceil(2 * n_buckets * parts / average) for value, parts in hot_keys(df, {"key": hashed})["key"].items()}
    tasks = {value: n for value, n in tasks.items() if n > 1}
    if not tasks:
        return df.repartition(n_buckets, _quoted(key))
    # By the values and the partition that a row is read in, which spreads identical rows as well.
    values = [_quoted(field.name) for field in df.schema.fields if isinstance(field.dataType, T.AtomicType)]
    own = F.xxhash64(F.spark_partition_id(), *values)
    # The same hash as that of the buckets.
    task, total = F.pmod(F.hash(_quoted(key)), F.lit(n_buckets)), n_buckets
    for value, n in tasks.items():
        task, total = F.when(hashed == value, F.lit(total) + F.pmod(own, F.lit(n)).cast("int")).otherwise(task), total + n
    return df.withColumn("__task", task).repartitionById(total, "__task").drop("__task")


def bucketed_join(spark: SparkSession, fact: str, dimension: str, key: str) -> DataFrame:
    """Inner join of two tables that were written by ``write_bucketed`` with the same key and number of buckets.

    The columns are those of ``star_join``. NULL keys match nothing and duplicate keys multiply rows. Tables whose keys
    or buckets differ are an error, since they would be shuffled.
    """
    facts, rows = spark.table(fact), spark.table(dimension)
    layouts = [_layout(spark, table) for table in (fact, dimension)]
    if layouts[0] != layouts[1] or layouts[0][1] != key.lower() or facts.schema[key].dataType != rows.schema[key].dataType:
        raise ValueError(f"{fact} and {dimension} are not in the same buckets of {key}: {layouts}")
    hashed = F.xxhash64(_quoted(key))
    found = hot_keys(facts.where(F.col(_quoted(key)).isNotNull()), {"key": hashed})["key"]
    if not found:
        return _merged(facts, rows, key)
    # Of keys that hold more than an average shuffle partition there are no more than such partitions.
    hot = F.broadcast(spark.createDataFrame([(value,) for value in found], "__hot long"))
    is_hot = hashed == F.col("__hot")
    cold = _merged(_without(facts, facts.join(hot, is_hot, "left_semi"), key).join(hot, is_hot, "left_anti"), rows, key)
    return cold.unionByName(star_join(facts.join(hot, is_hot, "left_semi"), [(rows.join(hot, is_hot, "left_semi"), key)]))


def _without(facts: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """``facts`` without the keys of ``hot`` as far as a filter can say it that is pushed into the scan."""
    column, kind = F.col(_quoted(key)), facts.schema[key].dataType
    if kind != T.StringType() and not isinstance(kind, (T.IntegralType, T.DateType)):
        return facts  # equal values of other types may have several forms
    values = [row[0] for row in hot.select(column).distinct().collect()]
    return facts.where(reduce(Column.__and__, (column != F.lit(value) for value in values), column.isNotNull()))


def _merged(facts: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The join of the two, bucket by bucket."""
    return facts.hint("merge").join(rows.hint("merge"), key)


def _layout(spark: SparkSession, table: str) -> tuple[int, str]:
    """Number of buckets and their column, as the catalog tells them."""
    told = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    columns = told.get("Bucket Columns", "").strip("[]`").lower()
    return int(told.get("Num Buckets", 0)), columns


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"

"""Table readers: Parquet, CSV and JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Each partition is one connection, so the database sets the limit and not the cluster.
JDBC_PARTITIONS = 32


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header row.

    Without a schema the types are inferred, which reads the data once more and
    turns text like ``0663713001`` into a number.
    """
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.csv(path, header=True, schema=schema)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    num_partitions: int = JDBC_PARTITIONS,
    predicates: Sequence[str] | None = None,
    sample: DataFrame | None = None,
    **options: str,
) -> DataFrame:
    """A whole database table: every column, every row.

    The caller says how to read in parallel, since only they know how the rows are
    distributed: ``partition_column`` cuts the range between its minimum and maximum, which the
    database computes, into ``num_partitions`` parts, and rows with a NULL there come with
    the first; with a ``sample`` of the table, such as an earlier snapshot, it is cut into parts of about as many rows
    each (``even_predicates``); ``predicates`` are conditions in the database's SQL, one for each task, which together
    have to take every row once. With none of them, one task reads the table over one connection, and a
    snapshot of it is one file unless ``n_files`` spreads it. ``options`` are those of Spark's JDBC
    source (``user``, ``password``, ``driver``, ``fetchsize`` and so on).
    """
    if predicates is not None:
        if partition_column is not None:
            raise ValueError("give either a partition column or predicates")
    elif sample is not None:
        if partition_column is None:
            raise ValueError("a sample needs a partition column")
        predicates = even_predicates(sample, partition_column, num_partitions, url)
    if predicates is not None:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)

    def load(**more: str) -> DataFrame:
        return spark.read.format("jdbc").options(url=url, **options, **more).load()

    if partition_column is None or num_partitions == 1:
        return load(dbtable=table)
    name = _quoted(partition_column, url)
    ends = load(query=f"SELECT MIN({name}) AS low, MAX({name}) AS high FROM {table}")
    low, high = ends.select(*(_bound(ends, column, up) for column, up in zip(ends.columns, (False, True)))).first()
    if low is None or high is None:
        return load(dbtable=table)
    return load(
        dbtable=table,
        partitionColumn=partition_column,
        lowerBound=low,
        upperBound=high,
        numPartitions=str(num_partitions),
    )


def even_predicates(sample: DataFrame, column: str, num_partitions: int, url: str) -> list[str]:
    """Conditions on ``column`` that cut a table into at most ``num_partitions`` parts of about as many rows each, by a sample of it.

    The bounds are those of an equi-depth histogram of the sample's values, found by one aggregate. Every row of the
    table, whatever its value, meets exactly one condition; NULL comes with the first. A value that fills more than a part is
    a part of its own, which no condition on this column can cut. Numbers, dates and timestamps only: how a database orders
    text is its own affair. A sample without values gives one part.
    """
    values = sample.select(F.col(_escaped(column)).alias("value"))
    kind = values.schema[0].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{column} has no order that is the same everywhere: give a number, date or timestamp, or predicates")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        values = values.where(~F.isnan("value"))
    shares = [i / num_partitions for i in range(1, num_partitions)]
    name = _quoted(column, url)
    if not shares:
        return ["1 = 1"]
    accuracy = max(10_000, 100 * num_partitions)
    found = values.agg(F.percentile_approx(_ordinal("value", kind), shares, accuracy).alias("bounds")).select(
        F.transform("bounds", lambda x: _of_ordinal(x, kind)).alias("bounds")
    )
    bounds = found.first().bounds or []
    literals = [_literal(value, kind) for value in bounds]
    edges: list[str] = list(dict.fromkeys(literals))
    heavy = {text for text in edges if literals.count(text) > 1}
    if not edges:
        return ["1 = 1"]
    parts = [f"{name} < {edges[0]} OR {name} IS NULL"]
    for low, high in zip(edges, [*edges[1:], None]):
        below = f" AND {name} < {high}" if high is not None else ""
        if low in heavy:
            parts += [f"{name} = {low}", f"{name} > {low}{below}"]
        else:
            parts.append(f"{name} >= {low}{below}")
    return parts


def _ordinal(name: str, kind: T.DataType) -> Column:
    """A number in the order of the values, exact for dates and timestamps."""
    if isinstance(kind, T.DateType):
        return F.unix_date(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(name).cast("timestamp"))
    return F.col(name)


def _of_ordinal(number: Column, kind: T.DataType) -> Column:
    """The value of an ordinal: text for dates and timestamps."""
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(number.cast("int")).cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_micros(number.cast("bigint")).cast("string")
    return number


def _literal(value: object, kind: T.DataType) -> str:
    if isinstance(kind, T.DateType):
        return f"DATE '{value}'"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return f"TIMESTAMP '{value}'"
    return format(value, "f") if isinstance(kind, T.DecimalType) else repr(value)


def _escaped(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _bound(ends: DataFrame, column: str, up: bool) -> Column:
    """A bound as Spark's JDBC source reads it: whole numbers, rounded away from the rows, or text of a date or timestamp.

    Null for a bound that is no whole number of 64 bits, as NaN: the table is then read in one part.
    """
    kind = ends.schema[column].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        whole = F.ceil(ends[column]) if up else F.floor(ends[column])
        inside = F.abs(ends[column]) < float(1 << 62)  # false for infinity; NaN is the largest number
        return F.when(inside, whole).cast("string")
    if isinstance(kind, T.DecimalType):
        whole = F.ceil(ends[column]) if up else F.floor(ends[column])
        return whole.try_cast("bigint").cast("string")
    return ends[column].cast("string")


def _quoted(name: str, url: str) -> str:
    """An identifier as the URL's database quotes it."""
    if url.startswith(("jdbc:mysql:", "jdbc:mariadb:", "jdbc:hive2:", "jdbc:databricks:")):
        return "`" + name.replace("`", "``") + "`"
    return '"' + name.replace('"', '""') + '"'

"""Snapshots whose columns were added or widened in the course of time, read as one frame.

The schemas are merged in the order of the snapshots. A column may come new, and its type may become one that holds all
earlier values exactly. Any other change is an error that names the column, the types and the snapshot.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailweave.sinks.commits import Commit, check, glob_of, log_of

_DIGITS = {"byte": 3, "short": 5, "integer": 10, "long": 19}
_EXACT_IN = {"float": 7, "double": 15}  # decimal digits that a floating-point number holds exactly


class NarrowedColumn(ValueError):
    """A later snapshot has a column in a type that does not hold all earlier values."""


def widened(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The type that holds the values of both, if that is ``new``; None if it is not."""
    if old == new or isinstance(old, T.NullType):
        return new
    kind, other = old.typeName(), new.typeName()
    if kind in _DIGITS and (other in _DIGITS and _DIGITS[other] > _DIGITS[kind] or other in _EXACT_IN and _EXACT_IN[other] >= _DIGITS[kind]):
        return new
    if kind in _DIGITS and isinstance(new, T.DecimalType) and new.precision - new.scale >= _DIGITS[kind]:
        return new
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new if new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale else None
    if (kind, other) in {("float", "double"), ("date", "timestamp_ntz")}:
        return new
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        inner = widened(old.elementType, new.elementType)
        return inner and T.ArrayType(inner, old.containsNull or new.containsNull)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        key, value = widened(old.keyType, new.keyType), widened(old.valueType, new.valueType)
        return key and value and T.MapType(key, value, old.valueContainsNull or new.valueContainsNull)
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        try:
            return merged_schema([("", old), ("", new)])
        except NarrowedColumn:
            return None
    return None


def merged_schema(snapshots: Sequence[tuple[str, T.StructType]]) -> T.StructType:
    """The columns of all ``(name, schema)`` in the order of their first appearance, each in its last and widest type.

    Names are the same if they differ in case alone, and keep their first spelling. A column that a later snapshot lacks stays.
    """
    columns: dict[str, T.StructField] = {}
    for name, schema in snapshots:
        for field in schema:
            old = columns.get(field.name.lower())
            if old is None:
                columns[field.name.lower()] = T.StructField(field.name, field.dataType, True)
                continue
            # A column of nulls alone says nothing of its type.
            wide = old.dataType if isinstance(field.dataType, T.NullType) else widened(old.dataType, field.dataType)
            if wide is None:
                raise NarrowedColumn(f"{field.name} was {old.dataType.simpleString()} and is {field.dataType.simpleString()} in {name}")
            columns[field.name.lower()] = T.StructField(old.name, wide, True)
    return T.StructType(list(columns.values()))


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of a merged schema: those it lacks are null, the others are cast."""
    own = {name.lower(): name for name in df.columns}
    return df.select(*(_cast(df, own.get(field.name.lower()), field.dataType).alias(field.name) for field in schema))


def _cast(df: DataFrame, name: str | None, kind: T.DataType) -> Column:
    if name is None:
        return F.lit(None).cast(kind)
    column = F.col("`" + name.replace("`", "``") + "`")
    return _to(column, df.schema[name].dataType, kind)


def _to(column: Column, old: T.DataType, new: T.DataType) -> Column:
    """Nested fields by their names, which a cast of structs would match by their places."""
    if old == new:
        return column
    if isinstance(old, T.StructType):
        own = {field.name.lower(): field for field in old}
        parts = []
        for field in new:
            at = own.get(field.name.lower())
            parts.append((_to(column[at.name], at.dataType, field.dataType) if at else F.lit(None).cast(field.dataType)).alias(field.name))
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(old, T.ArrayType):
        return F.transform(column, lambda x: _to(x, old.elementType, new.elementType))
    if isinstance(old, T.MapType):
        wide = F.transform_values(column, lambda _, x: _to(x, old.valueType, new.valueType))
        return F.transform_keys(wide, lambda x, _: _to(x, old.keyType, new.keyType))
    return column.cast(new)


def read_drifted(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The Parquet snapshots ``paths``, oldest first, as one frame. Files of one snapshot have one schema, which a footer of it tells."""
    parts = [(path, spark.read.parquet(path).schema) for path in paths]
    return _as_one(spark, parts, lambda schema, own: spark.read.schema(schema).parquet(*own))


def read_history(spark: SparkSession, root: str, commits: Sequence[Commit] | None = None) -> DataFrame:
    """The committed snapshots below ``root`` (all of them by default, in the order of their commits) as one frame, by the schemas of the log."""
    log = log_of(spark, root)
    commits = [Commit(number, **log.get(number)) for number in log.names()] if commits is None else commits
    for commit in commits:
        check(spark, root, commit)
    by_path = {f"{commit.path(root)}/{glob_of(commit.write_id)}": T.StructType.fromJson(json.loads(commit.schema)) for commit in commits}
    return _as_one(spark, list(by_path.items()), lambda schema, own: spark.read.schema(schema).parquet(*own))


def _as_one(spark: SparkSession, parts: Sequence[tuple[str, T.StructType]], read) -> DataFrame:
    if not parts:
        raise FileNotFoundError("no snapshots")
    schema = merged_schema(parts)
    # One scan for all snapshots of one schema.
    same: dict[str, tuple[T.StructType, list[str]]] = {}
    for path, own in parts:
        same.setdefault(own.json(), (own, []))[1].append(path)
    return reduce(DataFrame.unionByName, (conformed(read(own, paths), schema) for own, paths in same.values()))

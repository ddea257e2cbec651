"""Appends to warehouse tables that may be repeated.

Rows need no unique key: a customer may buy an article twice a day. So what is appended is a difference of numbers. Of
the rows of a batch with the same values in the key columns, as many are left out as the target has with those
values. A batch that is appended twice adds nothing the second time, and one that was appended in part adds the rest.

Nothing is collected, and no key's rows have to fit anywhere. The rows of the batch and the target's numbers are shuffled once,
by key, and numbered there. Hot keys, of which a sketch of the batch tells, are taken out: their rows are cut into parts by a hash of their
columns; the target's number is dealt out to the parts by running sums over them, and each part numbers its own rows. The order of a key's rows is
the same in both cases.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from retailweave.operators.joins import hot_keys
from retailweave.sinks.records import Folder
from retailweave.sinks.writers import Warehouse

PARTS = 64  # of the rows of a hot key


class LoadLedger:
    """Which loads were appended to which tables: a folder of records."""

    def __init__(self, spark: SparkSession, path: str):
        self._folder = lambda table: Folder(spark, f"{path.rstrip('/')}/{table}")

    def has(self, table: str, load_id: str) -> bool:
        return self._folder(table).get(_file_name(load_id)) is not None

    def listed(self, table: str) -> Callable[[str], bool]:
        """Tells which loads are listed now, by one listing of the folder."""
        names = set(self._folder(table).names())
        return lambda load_id: _file_name(load_id) in names

    def finished(self, table: str, load_id: str, n_rows: int | None = None) -> None:
        """Lists a load, with the number of rows that it added if that is known."""
        self._folder(table).put(_file_name(load_id), {"load_id": load_id, "n_rows": n_rows, "finished_at": time.time()})


def _file_name(load_id: str) -> str:
    return "".join(char if char.isalnum() or char in "-._" else f"%{ord(char):x}" for char in load_id).lstrip("._") or "%"


def missing_rows(batch: DataFrame, target: DataFrame, keys: Sequence[str], within: str | None = None) -> DataFrame:
    """The rows of ``batch`` beyond those that ``target`` has with the same ``keys``, by number.

    NULL is equal to NULL. Which rows of a key are left out follows from a hash of all their columns. ``within`` names a key
    column whose smallest and largest value in the batch limit what is read of the target, and whether nulls are.
    The target's keys are read as the batch's types.
    """
    names = {name.lower(): name for name in batch.columns}
    unknown = [key for key in keys if key.lower() not in names]
    if unknown or not keys:
        raise ValueError(f"keys that are no columns of the batch: {', '.join(unknown) or 'none given'}")
    keys = [names[key.lower()] for key in keys]
    if within is not None:
        target = _between(target, batch, names[within.lower()], {key.lower() for key in keys})
    # Structs compare their nulls as equal.
    key = F.struct(*(F.col(_quoted(name)).alias(f"k{i}") for i, name in enumerate(keys)))
    own = F.struct(*(F.col(_quoted(name)).cast(batch.schema[name].dataType).alias(f"k{i}") for i, name in enumerate(keys)))
    held = target.select(own.alias("of")).groupBy("of").agg(F.count("*").alias("held"))
    # The key's columns go through shuffles once, as the struct.
    of_key = {name: F.col("__key")[f"k{i}"].alias(name) for i, name in enumerate(keys)}
    narrow = batch.select(key.alias("__key"), *(_quoted(name) for name in batch.columns if name not in of_key))

    def whole(rows: DataFrame, *more: str) -> DataFrame:
        """With the columns of the batch, and the number of each row's part and the hash by which rows of a part are ordered."""
        rows = rows.select(*(of_key.get(name, F.col(_quoted(name))) for name in batch.columns), "__key", *more)
        rows = rows.withColumn("__row", F.xxhash64(*(_hashable(batch, name) for name in batch.columns)))
        return rows.withColumn("__part", F.pmod(F.xxhash64(F.lit(1), "__row"), F.lit(PARTS)).cast("int"))

    def of_cold(rows: DataFrame, held: DataFrame) -> DataFrame:
        matched = whole(rows.join(held, F.col("__key") == F.col("of"), "left"), "held")
        nth = F.row_number().over(W.partitionBy("__key").orderBy("__part", "__row"))
        return matched.withColumn("__nth", nth).where("__nth > coalesce(held, 0)").select(*(_quoted(name) for name in batch.columns))

    found = list(hot_keys(narrow, {"key": F.xxhash64("__key")})["key"])
    if not found:
        return of_cold(narrow, held)
    cold = of_cold(narrow.where(~F.xxhash64("__key").isin(found)), held.where(~F.xxhash64("of").isin(found)))
    return cold.unionByName(_of_hot(whole(narrow.where(F.xxhash64("__key").isin(found))), held.where(F.xxhash64("of").isin(found)), batch.columns))


def _of_hot(tagged: DataFrame, held: DataFrame, names: Sequence[str]) -> DataFrame:
    """The missing rows of keys that are too many for one task each."""
    counts = tagged.groupBy("__key", "__part").agg(F.count("*").alias("n"))
    # At most PARTS rows for each key.
    parts = W.partitionBy("__key").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(parts), F.lit(0))
    numbered = counts.withColumn("before", before)
    out = F.greatest(F.lit(0), F.least(F.col("n"), F.col("held") - F.col("before")))
    left_out = numbered.join(held, F.col("__key") == F.col("of")).select(
        F.col("__key").alias("__of"), F.col("__part").alias("__of_part"), out.alias("__out")
    )
    matched = tagged.join(left_out, (F.col("__key") == F.col("__of")) & (F.col("__part") == F.col("__of_part")), "left")
    nth = F.row_number().over(W.partitionBy("__key", "__part").orderBy("__row"))
    return matched.withColumn("__nth", nth).where("__nth > coalesce(__out, 0)").select(*(_quoted(name) for name in names))


def _between(target: DataFrame, batch: DataFrame, column: str, keys: set[str]) -> DataFrame:
    if column.lower() not in keys:
        raise ValueError(f"{column} is no key: rows with other values of it may have the same key")
    value = F.col(_quoted(column))
    low, high, nulls = batch.agg(F.min(value), F.max(value), F.max(value.isNull())).first()
    within = value.between(F.lit(low), F.lit(high)) if low is not None else F.lit(False)
    return target.where(within | value.isNull() if nulls else within)


def append_new(
    warehouse: Warehouse,
    batch: DataFrame,
    table: str,
    keys: Sequence[str],
    within: str | None = None,
    ledger: LoadLedger | None = None,
    load_id: str | None = None,
) -> int:
    """Appends ``missing_rows`` of ``batch`` to a table, which is made if it is not there, and returns how many those were.

    With a ledger, a load that it lists is not looked at again and adds 0 rows. A load that broke off is not listed; its repetition adds what is missing.
    """
    if (ledger is None) != (load_id is None):
        raise ValueError("a ledger and a load id go together")
    if ledger is not None and ledger.has(table, load_id):
        return 0
    target = warehouse.read(batch.sparkSession, table)
    new = batch if target is None else missing_rows(batch, target, keys, within)
    # Counted behind the last shuffle, in the tasks that write, so a repeated task counts once.
    told = Observation()
    warehouse.write(new.observe(told, F.count(F.lit(1)).alias("n")), table, "append")
    n_rows = told.get["n"]
    if ledger is not None:
        ledger.finished(table, load_id, n_rows)
    return n_rows


def _hashable(df: DataFrame, name: str) -> Column:
    column = F.col(_quoted(name))
    return F.to_json(F.struct(column)) if df.schema[name].dataType.typeName() in ("map", "variant") else column


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"

"""Sharding along a Hilbert curve, with DataFrame expressions only.

Several metadata columns are quantised to the same number of bits each, so that every
value of a column has about as many rows as the next. The cell of a row on the
curve orders the rows, and the order is cut into runs of equal length. Rows of a run are
near each other in every dimension, so minima and maxima of its columns let a
reader skip most shards for a filter on any of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from retailweave.llm.batches import quoted
from retailweave.sinks.scratch import written

BITS = 5
ACCURACY = 500  # of the quantiles: the error of a rank is a part in so many
SAMPLE = 10_000  # values of text, about, that the bounds are found among


def _gray_inverse(code: int) -> int:
    value = 0
    while code:
        value ^= code
        code >>= 1
    return value


def _trailing_ones(value: int) -> int:
    return (~value & (value + 1)).bit_length() - 1


def curve_tables(n: int) -> tuple[list[int], list[int]]:
    """For state * 2 ** n + cell bits: the next n bits of the curve index, and the next state.

    A state is the entry corner and the direction of a sub-cube. Within it the sub-cubes are
    visited in the order of the Gray code, seen from that corner.
    """
    corners = 1 << n
    left = lambda x, k: ((x << k % n) | (x >> (n - k % n))) & (corners - 1)
    digits, states = [], []
    for state in range(corners * n):
        entry, direction = divmod(state, n)
        for bits in range(corners):
            digit = _gray_inverse(left(bits ^ entry, n - (direction + 1) % n))
            even = 2 * ((digit - 1) // 2) if digit else 0
            turn = 0 if not digit else _trailing_ones(digit if digit % 2 else digit - 1) % n
            digits.append(digit)
            states.append((entry ^ left(even ^ (even >> 1), direction + 1)) * n + (direction + turn + 1) % n)
    return digits, states


def hilbert_index(cells: Sequence[Column], bits: int = BITS) -> Column:
    """Place on the curve of integer cells from 0 to 2 ** bits - 1, from the highest bit down."""
    n = len(cells)
    digits, states = (F.array(*map(F.lit, table)) for table in curve_tables(n))

    def step(at: Column, level: Column) -> Column:
        corner = sum((F.call_function("shiftright", cell, level).bitwiseAND(1) * (1 << j) for j, cell in enumerate(cells)), F.lit(0))
        place = (at["state"] * (1 << n) + corner + 1).cast("int")
        return F.struct(
            (at["index"] * (1 << n) + F.element_at(digits, place)).alias("index"), F.element_at(states, place).alias("state")
        )

    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("state"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step)["index"]


def _is_text(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.BinaryType))


def _ordered(name: str, kind: T.DataType) -> Column:
    """A double in the order of the values; whole text and binary values by their bytes."""
    column = quoted(name)
    if _is_text(kind):
        return column.cast("binary")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.BooleanType)):
        return column.cast("double") if isinstance(kind, T.TimestampType) else column.cast("int").cast("double")
    return F.nanvl(column.cast("double"), F.lit(None))


def _quantised(df: DataFrame, dimensions: Sequence[str], bits: int) -> list[Column]:
    """The cell of each dimension; 0 for null. The bounds are quantiles over all rows."""
    kinds = [df.schema[name].dataType for name in dimensions]
    values = [_ordered(name, kind) for name, kind in zip(dimensions, kinds)]
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(
        *((F.count(x) if _is_text(kind) else F.percentile_approx(x, shares, ACCURACY)).alias(f"d{i}") for i, (x, kind) in enumerate(zip(values, kinds)))
    ).first()
    bounds = [_text_bounds(df.select(x.alias("value")), own, shares) if _is_text(kind) else own for x, kind, own in zip(values, kinds, found)]
    return [_cell(x, own) if own else F.lit(0) for x, own in zip(values, bounds)]


def _text_bounds(df: DataFrame, total: int, shares: Sequence[float], sample: int = SAMPLE) -> list[bytes]:
    """Quantiles of the whole values, of which ``total`` are not null.

    A value is looked at if it has at least one row in ``sample``, or else with a chance in proportion
    to its rows, decided by its hash, and then counts as one row in ``sample``. So up to ``sample`` different
    values are exact, and about twice as many at most are put in order.
    """
    if not total:
        return []
    least = max(1.0, total / sample)
    counts = df.where("value is not null").groupBy("value").agg(F.count("*").alias("n"))
    chance = F.pmod(F.xxhash64("value"), F.lit(1 << 30)) / float(1 << 30)
    weights = counts.where(chance < F.col("n") / least).select("value", F.greatest(F.col("n").cast("double"), F.lit(least)).alias("weight"))
    sums = weights.select("value", F.sum("weight").over(W.orderBy("value")).alias("up_to"), F.sum("weight").over(W.partitionBy()).alias("all"))
    found = sums.agg(*(F.min(F.when(F.col("up_to") >= share * F.col("all"), F.col("value"))).alias(f"b{i}") for i, share in enumerate(shares)))
    return [bytes(bound) for bound in found.first() if bound is not None]


def _cell(x: Column, bounds: Sequence[float] | Sequence[bytes]) -> Column:
    """How many of the bounds are not above ``x``."""
    return F.when(x.isNull(), 0).otherwise(F.size(F.filter(F.array(*map(F.lit, bounds)), lambda bound: bound <= x))).cast("int")


def hilbert_shards(df: DataFrame, dimensions: Sequence[str], n_shards: int, bits: int = BITS) -> DataFrame:
    """``df`` with ``shard`` (0 to ``n_shards`` - 1), ``slot`` (from 0, without gaps) and ``curve_index``.

    Numbers of rows differ by at most one between shards. Rows of one cell follow each other by the hash of
    all their columns. Nulls and NaN are the lowest cell of a dimension. Columns of ``df`` that are
    named like a result, in any case, are replaced. The order is written once to the shared work
    folder, so a task that is repeated finds the same one.
    """
    new = {"shard", "slot", "curve_index"}
    kept = [name for name in df.columns if name.lower() not in new]
    cells = {f"__cell{i}": cell for i, cell in enumerate(_quantised(df, dimensions, bits))}
    row = F.xxhash64(*(quoted(name) for name in kept))
    placed = df.select(*(quoted(name) for name in kept), *(cell.alias(name) for name, cell in cells.items())).withColumn(
        "curve_index", hilbert_index([F.col(name) for name in cells], bits)
    )
    ordered = written(
        placed.drop(*cells)
        .withColumn("__row", row)
        .orderBy("curve_index", "__row")
        .withColumn("__place", F.monotonically_increasing_id())
    )
    # The number has the sorted partition in its upper bits and the row within it in the lower 33.
    parted = ordered.withColumns({"__part": F.shiftright("__place", 33), "__nth": F.col("__place") % (1 << 33)})
    counts = parted.groupBy(F.col("__part").alias("__of")).agg(F.count("*").alias("__n"))
    # One row for each sorted partition, of which there are at most spark.sql.shuffle.partitions.
    before = counts.select(
        "__of",
        (F.sum("__n").over(W.orderBy("__of")) - F.col("__n")).alias("__before"),
        F.sum("__n").over(W.partitionBy()).alias("__total"),
    )
    # The first shards have one row more than the others. With fewer rows than shards each has one or none.
    ranked = parted.join(F.broadcast(before), F.col("__part") == F.col("__of")).select(
        "*",
        (F.col("__before") + F.col("__nth")).alias("__rank"),
        F.expr(f"greatest(__total div {n_shards}, 1)").alias("__size"),
        F.expr(f"if(__total < {n_shards}, 0, __total % {n_shards})").alias("__longer"),
    )
    first = "__longer * (__size + 1)"
    return ranked.select(
        *(quoted(name) for name in kept),
        "curve_index",
        F.expr(f"cast(if(__rank < {first}, __rank div (__size + 1), __longer + (__rank - {first}) div __size) as int)").alias("shard"),
        F.expr(f"if(__rank < {first}, __rank % (__size + 1), (__rank - {first}) % __size)").alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """The rows as Parquet folders ``shard=N``, each sorted by slot."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

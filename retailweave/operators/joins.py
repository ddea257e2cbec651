"""Star join of a fact table with its dimensions.

A dimension is joined in one of two ways, chosen by its measured size:

* by a broadcast: it goes to every executor and the fact table is not shuffled, so a
  hot key costs nothing. Taken only after measuring that it fits together with
  the other broadcast dimensions.
* by a shuffle: without a hint, so that Spark picks and AQE re-plans, or with one for a merge
  join. Before the shuffle the hot keys of the fact table are salted: their rows are
  spread over several parts, and the dimension rows of those keys are copied to each
  part. Keys that a dimension repeats that often are salted the other way
  round. Every fact row still meets every dimension row of its key exactly once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from math import ceil
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

MAX_BROADCAST_BYTES = 512 * 1024 * 1024
STRATEGIES = ("broadcast", "shuffle", "merge")

# Fewer rows than this are no load for a task, and no part of a hot key has fewer.
HOT_ROWS = 1000
# Sketches are merged in so many groups, and those in so many more, before the last task merges them.
SKETCH_GROUPS = (512, 24)

_UNKNOWN_BYTES = 1 << 60  # Spark's size for sources that have none is larger

# The frequent-items sketches track so many hashes for each shuffle partition, at least
# and at most as many as given. At most one key per partition can hold more than an average partition.
TRACKED_PER_PARTITION = 10
TRACKED_KEYS = (10_000, 1_000_000)

# Parts of a hot key per average partition its rows would fill. Parts meet in a
# partition by chance, so several small ones spread better than one of full size.
PARTS_PER_PARTITION = 4


def star_join(
    fact: DataFrame,
    dimensions: Sequence[tuple[DataFrame, str]],
    strategy: str = "broadcast",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    accounts: Accounts | None = None,
) -> DataFrame:
    """Inner equi-join of ``fact`` with every ``(dimension, key)``. The rows are the same for every strategy.

    Columns: the keys, each once and the last one first, then the other columns of the fact
    table and of each dimension in turn. Fact rows without a match, or with a NULL
    key, drop out; a key that a dimension holds twice yields two rows. Several dimensions may
    have the same key.

    ``strategy="broadcast"`` broadcasts the smallest dimensions that together measure at most
    ``max_broadcast_bytes`` and shuffles the others; ``"shuffle"`` hints nothing and ``"merge"`` asks for
    sort-merge joins.

    ``accounts`` says, after the rows were computed once, how many of them went and why.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}")
    keys, columns = output_columns(fact, dimensions)
    sides = [_Side.of(i, fact, dimension, key) for i, (dimension, key) in enumerate(dimensions)]
    small = _fitting([side.dimension for side in sides], max_broadcast_bytes) if strategy == "broadcast" else set()
    if accounts is not None:
        fact = accounts.begin(fact, sides)
        sides = [side.numbered() for side in sides]
    shuffled = [side for i, side in enumerate(sides) if i not in small]
    # Sketched and salted before the first join, which would be computed once more otherwise.
    fact, shuffled = _salted(fact, shuffled)
    # Inner joins commute: broadcast first, so that fewer rows reach a shuffle.
    order = [(sides[i], F.broadcast(sides[i].dimension)) for i in sorted(small)]
    order += [(side, side.dimension.hint("merge") if strategy == "merge" else side.dimension) for side in shuffled]
    for i, (side, dimension) in enumerate(order):
        if accounts is not None:
            fact = accounts.before(fact, [later for later, _ in order[i:]])
        fact = side.join(fact, dimension)
        if accounts is not None:
            fact = accounts.after(fact, side, [later for later, _ in order[i + 1 :]])
    return fact.select(*keys, *columns)


class Accounts:
    """Counts of a star join, made in the pass that computes its rows. An object serves one join.

    ``get()`` waits for an action on the joined frame: ``rows_in``, ``rows_out``, ``null_keys`` (rows that miss any key), and for each
    key ``null_<key>`` (rows that miss it, or whose text does not read as the dimension's type) and ``orphans_<key>`` (rows with all keys that
    reached its join and found no dimension row). Joins run one after the other, broadcast ones first, so a row that one
    took away is no orphan of a later one. A task that is repeated upstream of a shuffle counts its rows again.
    """

    def __init__(self):
        self._keys: list[str] = []
        self._begun, self._reached, self._found = Observation(), {}, {}

    def begin(self, fact: DataFrame, sides: Sequence[_Side]) -> DataFrame:
        self._keys = [side.key if [s.key.lower() for s in sides].count(side.key.lower()) == 1 else f"{side.key}_{side.number}" for side in sides]
        missing = [side.fact_key.isNull() for side in sides]
        nulls = (F.count_if(is_null).alias(f"null_{key}") for is_null, key in zip(missing, self._keys))
        any_null = reduce(or_, missing, F.lit(False))
        counted = fact.observe(self._begun, F.count(F.lit(1)).alias("rows_in"), F.count_if(any_null).alias("null_keys"), *nulls)
        return counted.where(~any_null)

    def before(self, fact: DataFrame, pending: Sequence[_Side]) -> DataFrame:
        told = self._reached[pending[0].number] = Observation()
        return fact.observe(told, F.count_if(_original(pending)).alias("n"))

    def after(self, fact: DataFrame, side: _Side, pending: Sequence[_Side]) -> DataFrame:
        """Counts each fact row by the first of the dimension rows that it found."""
        self._found[side.number] = Observation()
        first = F.count_if(F.col(f"__first_{side.number}") & _original(pending)).alias("n")
        return fact.observe(self._found[side.number], first, F.count(F.lit(1)).alias("rows")).drop(f"__first_{side.number}")

    def get(self) -> dict[str, int]:
        out = dict(self._begun.get)
        for i, key in enumerate(self._keys):
            out[f"orphans_{key}"] = self._reached[i].get["n"] - self._found[i].get["n"]
        return out | {"rows_out": self._found[list(self._found)[-1]].get["rows"] if self._found else out["rows_in"]}


@dataclass(frozen=True)
class _Side:
    """A dimension whose key is renamed to ``on``, and the fact table's key, read as the type both are compared in.

    ``salts`` are pairs of a column of the fact table and one of the dimension that have to be
    equal as well.
    """

    number: int
    key: str
    fact_key: Column
    on: str
    hashed: T.DataType
    dimension: DataFrame
    salts: tuple[tuple[str, str], ...] = ()

    @staticmethod
    def of(number: int, fact: DataFrame, dimension: DataFrame, key: str) -> _Side:
        """Text keys are read as the other side's type where only one side is text.

        Text that does not read as that type matches nothing instead of failing.
        """
        on, fact_key = f"__on_{number}", F.col(_quoted(key))
        left, right = (df.select(_quoted(key)).schema[0].dataType for df in (fact, dimension))
        text_left, text_right = (isinstance(data_type, T.StringType) for data_type in (left, right))
        dimension = dimension.withColumnRenamed(key, on)
        if text_left and not text_right:
            fact_key, common = fact_key.try_cast(right), right
        elif text_right and not text_left:
            dimension, common = dimension.withColumn(on, F.col(on).try_cast(left)), left
        else:
            both = fact.select(_quoted(key)).limit(0).union(dimension.select(on).limit(0))
            common = both.schema[0].dataType
        return _Side(number, key, fact_key, on, common, dimension)

    def numbered(self) -> _Side:
        """With a column that says which of the rows of a key is the first; the dimension alone is shuffled for it."""
        first = F.row_number().over(W.partitionBy(self.on).orderBy(F.lit(0))) == 1
        return replace(self, dimension=self.dimension.withColumn(f"__first_{self.number}", first))

    def hash_of(self, column: Column) -> Column:
        """The same number on both sides for keys that are equal; any type of key has one."""
        return F.xxhash64(column.cast(self.hashed))

    def join(self, fact: DataFrame, dimension: DataFrame) -> DataFrame:
        pairs = [self.fact_key == F.col(self.on), *(F.col(left) == F.col(right) for left, right in self.salts)]
        return fact.join(dimension, reduce(and_, pairs)).drop(self.on, *(right for _, right in self.salts))


def _original(pending: Sequence[_Side]) -> Column:
    """Whether a row is the first of the copies of a fact row that were made for joins to come."""
    copies = [left for side in pending for left, _ in side.salts if left.startswith("__copied_")]
    return reduce(and_, (F.col(name) == 0 for name in copies), F.lit(True))


def _salted(fact: DataFrame, sides: Sequence[_Side]) -> tuple[DataFrame, list[_Side]]:
    """The fact table and the sides with a salt for each hot key of either."""
    if not sides:
        return fact, []
    fact = fact.where(reduce(and_, (side.fact_key.isNotNull() for side in sides)))
    dimensions = [side.dimension.where(F.col(side.on).isNotNull()) for side in sides]
    # Sides that read the same key as the same type share its salt.
    salts: dict[tuple[str, str], tuple[str, _Side]] = {}
    for side in sides:
        same = (side.key.lower(), side.hashed.json())
        taken = {name for name, _ in salts.values()}
        name = f"__salt_{side.key}" if f"__salt_{side.key}" not in taken else f"__salt_{side.key}_{side.number}"
        salts.setdefault(same, (name, side))
    hot = hot_keys(fact, {name: side.hash_of(side.fact_key) for name, side in salts.values()})
    repeated = _hot_keys_of_each([df.select(side.hash_of(F.col(side.on)).alias("key")) for side, df in zip(sides, dimensions)])
    made = {name: _Salt.of(name, fact, hot[name]) for name in hot if hot[name]}
    for name, side in salts.values():
        if name in made:
            fact = made[name].spread(fact, side.hash_of(side.fact_key))
    out = []
    for side, dimension, own in zip(sides, dimensions, repeated):
        pairs = []
        name, _ = salts[side.key.lower(), side.hashed.json()]
        if name in made:
            copy = f"__part_{side.number}"
            dimension = made[name].copy(dimension, side.hash_of(F.col(side.on)), copy)
            pairs.append((name, copy))
        if own:
            salt = _Salt.of(f"__copy_{side.number}", dimension, own)
            dimension = salt.spread(dimension, side.hash_of(F.col(side.on)))
            copy = f"__copied_{side.number}"
            fact = salt.copy(fact, side.hash_of(side.fact_key), copy)
            pairs.append((copy, salt.name))
        out.append(_Side(side.number, side.key, side.fact_key, side.on, side.hashed, dimension, tuple(pairs)))
    return fact, out


@dataclass(frozen=True)
class _Salt:
    """A second join column that cuts the rows of each hot key into several parts.

    One side is spread over the parts and the other is copied to each of them,
    so that two rows with the same key meet in exactly one part.
    """

    name: str
    parts: DataFrame

    @staticmethod
    def of(name: str, df: DataFrame, hot: Mapping[int, int]) -> _Salt:
        return _Salt(name, df.sparkSession.createDataFrame(list(hot.items()), "__hash long, __parts int"))

    def spread(self, df: DataFrame, hashed: Column) -> DataFrame:
        """Every row to one part, by its values and the partition it is read in.

        That spreads identical rows too, and a repeated task does the same again.
        """
        values = [_quoted(field.name) for field in df.schema.fields if isinstance(field.dataType, T.AtomicType)]
        part = F.pmod(F.xxhash64(F.spark_partition_id(), *values), "__parts").cast("int")
        return self._with_parts(df, hashed).withColumn(self.name, F.when(F.col("__parts") > 1, part).otherwise(0)).drop("__parts")

    def copy(self, df: DataFrame, hashed: Column, name: str) -> DataFrame:
        """Every row to all parts of its key."""
        parts = F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))
        return self._with_parts(df, hashed).withColumn(name, parts).drop("__parts")

    def _with_parts(self, df: DataFrame, hashed: Column) -> DataFrame:
        """``df`` with the number of parts of its key, which is 1 for all but the hot keys."""
        # At most one row for each shuffle partition, hence safe to broadcast.
        found = df.join(F.broadcast(self.parts), hashed == F.col("__hash"), "left").drop("__hash")
        return found.withColumn("__parts", F.coalesce("__parts", F.lit(1)))


def hot_keys(df: DataFrame, keys: Mapping[str, Column]) -> dict[str, dict[int, int]]:
    """For each named column of numbers, the values that hold more than one average shuffle partition.

    Each comes with the number of parts that spread its rows evenly, none of fewer than
    ``HOT_ROWS`` rows. One pass over the columns shuffles no rows: each task keeps a
    frequent-items sketch of fixed size per column, and the sketches are merged in three
    steps (``SKETCH_GROUPS``), so that what the last task receives does not depend on the number of tasks.
    There can be no more such values than partitions, and the sketches hold as many.
    """
    return _hot(df.select(F.lit(0).alias("df"), *(column.alias(name) for name, column in keys.items())), list(keys)).get(
        0, {name: {} for name in keys}
    )


def _hot_keys_of_each(frames: Sequence[DataFrame]) -> list[dict[int, int]]:
    """The same for the column ``key`` of several frames, in one pass."""
    found = _hot(reduce(DataFrame.union, (df.select(F.lit(i).alias("df"), "key") for i, df in enumerate(frames))), ["key"])
    return [found.get(i, {"key": {}})["key"] for i in range(len(frames))]


def _hot(rows: DataFrame, names: Sequence[str]) -> dict[int, dict[str, dict[int, int]]]:
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least, most = TRACKED_KEYS
    tracked = min(max(TRACKED_PER_PARTITION * partitions, least), most)
    taken = min(partitions, tracked - 1)
    wide, narrow = SKETCH_GROUPS
    sketches = rows.groupBy("df", F.pmod(F.spark_partition_id(), F.lit(wide)).alias("__group")).agg(
        F.count("*").alias("__n"), *(F.expr(f"approx_top_k_accumulate({_quoted(name)}, {tracked})").alias(name) for name in names)
    )
    sketches = sketches.groupBy("df", F.pmod("__group", F.lit(narrow)).alias("__group")).agg(
        F.sum("__n").alias("__n"), *(F.expr(f"approx_top_k_combine({_quoted(name)}, {tracked})").alias(name) for name in names)
    )
    merged = sketches.groupBy("df").agg(
        F.sum("__n").alias("__n"),
        *(
            F.expr(f"approx_top_k_estimate(approx_top_k_combine({_quoted(name)}, {tracked}), {taken})").alias(name)
            for name in names
        ),
    )
    return {
        row["df"]: {
            name: {
                top["item"]: min(ceil(PARTS_PER_PARTITION * top["count"] * partitions / row["__n"]), ceil(top["count"] / HOT_ROWS))
                for top in row[name]
                if top["count"] * partitions > row["__n"] and top["count"] >= HOT_ROWS
            }
            for name in names
        }
        for row in merged.collect()
    }


def _fitting(dimensions: Sequence[DataFrame], max_bytes: int) -> set[int]:
    """The numbers of the dimensions to broadcast: the smallest that fit in ``max_bytes`` together."""
    worth_measuring = [i for i, df in enumerate(dimensions) if _scan_bytes(df) <= max_bytes]
    sizes = sorted(zip(measured_bytes([dimensions[i] for i in worth_measuring]), worth_measuring))
    fit, total = set(), 0
    for size, i in sizes:
        total += size
        if total <= max_bytes:
            fit.add(i)
    return fit


def _scan_bytes(df: DataFrame) -> int:
    """Spark's estimate for a frame made from one source by projections, which is at least what its files hold.

    0 for other frames and where Spark has no estimate. What is filtered to far less than its files hold is
    not broadcast for it; AQE may still do so.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    if plan.collectLeaves().size() != 1:
        return 0
    size = int(str(plan.stats().sizeInBytes()))
    return 0 if size >= _UNKNOWN_BYTES else size


def measured_bytes(frames: Sequence[DataFrame]) -> list[int]:
    """Size of each frame's rows in memory as a broadcast table holds them, by one aggregate over all."""
    if not frames:
        return []
    rows = reduce(DataFrame.union, (df.select(F.lit(i).alias("i"), _row_bytes(df).alias("bytes")) for i, df in enumerate(frames)))
    found = {row.i: row.bytes for row in rows.groupBy("i").agg(F.sum("bytes").alias("bytes")).collect()}
    return [found.get(i, 0) for i in range(len(frames))]


def _row_bytes(df: DataFrame) -> Column:
    """Twice eight bytes per column and for the entry itself, and the text on top."""
    size = F.lit(16 * (len(df.columns) + 2)).cast("bigint")
    for field in df.schema.fields:
        column = F.col(_quoted(field.name))
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif not isinstance(field.dataType, T.AtomicType):
            # Nested values at 16 bytes for each character of their text.
            size = size + F.coalesce(16 * F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return size


def output_columns(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, str]]) -> tuple[list[str], list[str]]:
    """The keys and the other columns in output order; an error names those that occur twice."""
    distinct = {key.lower(): key for _, key in reversed(dimensions)}
    names = [name for name in fact.columns if name.lower() not in distinct]
    for dimension, key in dimensions:
        names += [name for name in dimension.columns if name.lower() != key.lower()]
    times = Counter([name.lower() for name in names] + list(distinct))
    twice = sorted(name for name, n in times.items() if n > 1)
    if twice:
        raise ValueError(f"columns on more than one side of the star join: {', '.join(twice)}")
    return [_quoted(key) for key in distinct.values()], [_quoted(name) for name in names]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"

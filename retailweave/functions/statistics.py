"""Statistics as one-row frames.

Used with ``DataFrame.scalar()`` they become scalar subqueries of the plan that
needs them, so no join is needed. ``mode`` is computed with that plan;
``exact_quantile`` is searched when it is called and the frame holds the value.
"""

from __future__ import annotations

from math import ceil, inf

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

# Sketches are merged in this many groups of tasks, and each group is summed up
# by the values at this many even steps.
SKETCH_GROUPS = 128
SKETCH_STEPS = 1000

# The search goes on until fewer rows than this are left, whose distinct values one task counts.
COUNTED_ROWS = 20_000


def exact_quantile(
    df: DataFrame, column: str, q: float = 0.5, accuracy: int = 2000, counted_rows: int = COUNTED_ROWS
) -> DataFrame:
    """One row ``(value double)``: the smallest value with at least ``q`` of the rows at or below it.

    For ``q = 0.5`` this is the lower median. NULL and NaN are left out; without
    any value the result is NULL.

    An exact quantile alone keeps every distinct value in one task. Here each round takes
    sketches of bounded size of the rows in an open interval, and their error bound gives two
    values that enclose the answer. Row counts decide whether the answer is one of the two, lies between
    them, or, where a sketch missed its bound, outside: they are the ends of the next interval. A
    round leaves less than one in a hundred rows. When about ``counted_rows`` are left, the
    column is clamped to the two values, which does not move the quantile, and the distinct
    values in between are counted.
    """
    values = df.select(F.col(column).cast("double").alias("value")).where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )
    return df.sparkSession.range(1).select(F.lit(_search(values, q, accuracy, counted_rows)).cast("double").alias("value"))


def _search(values: DataFrame, q: float, accuracy: int, counted_rows: int) -> float | None:
    # A rank read from the weighted steps is off by at most one step and one sketch error.
    margin = 2 * (1 / SKETCH_STEPS + 1 / accuracy)
    low, high, before, rank = -inf, inf, 0, None
    while True:
        # The first round has no ends yet, and infinite values belong to it.
        inside = values if rank is None else values.where((F.col("value") > low) & (F.col("value") < high))
        groups = _sketches(inside, accuracy)
        n_inside = sum(group.n_rows for group in groups)
        if rank is None:
            if not n_inside:
                return None
            rank = max(ceil(q * n_inside), 1)
        share = (rank - before) / n_inside
        a, b = _weighted(groups, max(share - margin, 0.0)), _weighted(groups, min(share + margin, 1.0))
        few = 2 * margin * n_inside <= counted_rows
        found = _counts(values, a, b, q if few else None)
        if found.below < rank <= found.through:
            if few:
                return found.value
            if rank <= found.at_low:
                return a
            if rank > found.under_high:
                return b
            low, high, before = a, b, found.at_low
        elif rank <= found.below:
            high = a
        else:
            low, before = b, found.through


def _sketches(values: DataFrame, accuracy: int) -> list[Row]:
    """Number of rows and values at even steps, for every group of tasks."""
    steps = ", ".join(f"{i / SKETCH_STEPS}D" for i in range(SKETCH_STEPS + 1))
    # At most SKETCH_GROUPS rows of SKETCH_STEPS values come to the driver.
    return (
        values.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("part"))
        .agg(F.expr(f"percentile_approx(value, array({steps}), {accuracy})").alias("steps"), F.count("*").alias("n_rows"))
        .collect()
    )


def _weighted(groups: list[Row], share: float) -> float:
    """The smallest step with at least ``share`` of the rows' weight at or below it."""
    steps = sorted((step, group.n_rows) for group in groups for step in group.steps)
    wanted, total = share * sum(weight for _, weight in steps), 0
    for step, weight in steps:
        total += weight
        if total >= wanted:
            return step
    return steps[-1][0]


def _counts(values: DataFrame, a: float, b: float, q: float | None) -> Row:
    """Rows below ``a``, up to and with it, below ``b``, up to and with it; with ``q`` the quantile clamped to a and b, too."""
    value = F.col("value")
    counts = [
        F.count_if(value < a).alias("below"),
        F.count_if(value <= a).alias("at_low"),
        F.count_if(value < b).alias("under_high"),
        F.count_if(value <= b).alias("through"),
    ]
    if q is not None:
        clamped = values.withColumn("clamped", F.least(F.greatest("value", F.lit(a)), F.lit(b)))
        return clamped.agg(*counts, F.expr(f"percentile_disc({q!r}) WITHIN GROUP (ORDER BY clamped)").alias("value")).first()
    return values.agg(*counts).first()


def group_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value as ``(column, count)``; NULL is a value of its own."""
    return df.groupBy(column).count()


def top_groups(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values with their counts; ties go to the smaller value, NULL last."""
    return group_counts(df, column).orderBy(F.col("count").desc(), F.col(column).asc_nulls_last()).limit(k)


def mode(df: DataFrame, column: str) -> DataFrame:
    """One row ``(column)``: the most frequent value, which can be NULL. No row for an empty input."""
    return top_groups(df, column, 1).select(column)

import math
import random

import pytest
from pyspark.sql import functions as F

from retailweave.llm.grid_join import near_duplicates

from conftest import rows
from llm.conftest import as_dict

SCHEMA = "vec_id long, label int, embedding array<float>"


def usable(label, vector):
    return label is not None and vector and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def brute(table, threshold=0.98):
    """``{id: (links, component)}`` by comparing all pairs."""
    links = {row[0]: set() for row in table}
    for i, (a, x, u) in enumerate(table):
        for b, y, v in table[:i]:
            if usable(x, u) and usable(y, v) and x == y and len(u) == len(v):
                cosine = sum(p * q for p, q in zip(u, v)) / math.sqrt(sum(p * p for p in u) * sum(q * q for q in v))
                if cosine >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    out = {}
    for a in links:
        stack, seen = [a], {a}
        while stack:
            new = links[stack.pop()] - seen
            seen |= new
            stack += new
        out[a] = (len(links[a]), min(seen))
    return out


def vectors(n, dim, seed=1, spread=0.12):
    """Clusters whose members are near the threshold, in float precision."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(max(1, n // 12))]
    import numpy as np

    return [
        (i, rng.choice([0, 0, 0, 1, None]), [float(np.float32(x + rng.gauss(0, spread))) for x in rng.choice(centres)])
        for i in range(n)
    ]


@pytest.mark.parametrize("block_rows, directions", [(1024, 3), (16, 3), (7, 1), (16, 8)])
def test_equals_brute_force(spark, block_rows, directions):
    table = vectors(300, 8)
    df = spark.createDataFrame(table, SCHEMA).repartition(4)
    found = near_duplicates(df, block_rows=block_rows, directions=directions)
    expected = brute(table)
    assert any(n for n, _ in expected.values())
    assert as_dict(found, "vec_id", "n_links", "component_id") == expected
    assert all(row.kept == (row.vec_id == row.component_id) for row in found.collect())


def test_the_sample_changes_no_result(spark):
    table = vectors(150, 6, seed=2)
    df = spark.createDataFrame(table, SCHEMA)
    for sample in (1, 2, 40):
        assert as_dict(near_duplicates(df, sample=sample, block_rows=20), "vec_id", "n_links", "component_id") == brute(table)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    table = [
        (0, 1, [1.0, 0.0]),
        (1, 1, [2.0, 0.0]),
        (2, 1, [1.0, 0.0]),
        (3, 2, [1.0, 0.0]),
        (4, None, [1.0, 0.0]),
        (5, 1, None),
        (6, 1, []),
        (7, 1, [0.0, 0.0]),
        (8, 1, [1.0, None]),
        (9, 1, [1.0, nan]),
        (10, 1, [1.0, inf]),
        (11, 1, [1.0, 0.0, 0.0]),
        (12, 1, [-1.0, -0.0]),
        (13, 1, [1e-30, 0.0]),
        (14, 1, [1e30, 0.0]),
        (15, 1, [3.0]),
        (16, 1, [5.0]),
        (17, 1, [-5.0]),
    ]
    found = as_dict(near_duplicates(spark.createDataFrame(table, SCHEMA)), "vec_id", "n_links", "component_id")
    assert found == brute(table)
    assert found[0] == (4, 0) and found[7] == (0, 7) and found[16] == (1, 15)


def test_one_vector_many_times(spark):
    """Two thousand equal vectors are one node, and so is a group of different ones nearby in full."""
    df = spark.range(2_500).select(
        F.col("id").alias("vec_id"),
        F.lit(1).alias("label"),
        F.array(F.lit(1.0), F.when(F.col("id") < 2_000, 0.0).otherwise(F.col("id") / 1e6)).cast("array<float>").alias("embedding"),
    )
    found = near_duplicates(df, block_rows=64)
    assert found.groupBy("n_links", "component_id").count().collect() == [(2_499, 0, 2_500)]


def test_null_ids_repeated_rows_clashing_columns_and_no_rows(spark, clashing):
    table = [(None, 1, [1.0, 0.0]), (4, 1, [1.0, 0.0]), (4, 1, [1.0, 0.0]), (None, 1, None), (None, 2, [1.0, 0.0])]
    df = clashing(spark.createDataFrame(table, SCHEMA), "node", "n_links", "id", "block")
    assert rows(near_duplicates(df)) == sorted(
        [(4, 2, 4, True), (4, 2, 4, True), (None, 2, 4, False), (None, 0, None, True), (None, 0, None, True)], key=repr
    )
    empty = near_duplicates(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns == ["vec_id", "n_links", "component_id", "kept"]

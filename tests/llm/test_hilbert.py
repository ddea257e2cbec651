import bisect
import itertools
import math

import pytest
from pyspark.sql import functions as F

from retailweave.llm.hilbert import _text_bounds, curve_tables, hilbert_index, hilbert_shards, write_shards
from retailweave.llm.queries import QUERIES

from conftest import rows
from llm.conftest import as_dict


@pytest.mark.parametrize("n, bits", [(1, 3), (2, 1), (2, 4), (3, 1), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_and_steps_to_a_neighbour(spark, n, bits):
    cells = list(itertools.product(range(1 << bits), repeat=n))
    df = spark.createDataFrame(cells, ", ".join(f"c{i} int" for i in range(n)))
    place = {tuple(row[:n]): row.h for row in df.select("*", hilbert_index([F.col(f"c{i}") for i in range(n)], bits).alias("h")).collect()}
    order = sorted(place, key=place.get)
    assert sorted(place.values()) == list(range(1 << bits * n))
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(order, order[1:]))


def test_tables_have_every_digit_once():
    for n in (1, 2, 3, 4):
        digits, states = curve_tables(n)
        for state in range(n << n):
            assert sorted(digits[state << n : (state + 1) << n]) == list(range(1 << n))
        assert set(states) <= set(range(n << n))


def table(spark, n):
    return spark.range(0, n, 1, 5).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 7 != 0, F.element_at(F.array(*map(F.lit, ("en", "de", "fr"))), (F.col("id") % 3 + 1).cast("int"))).alias("lang"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("src"), F.col("id") % 20)).alias("source"),
        F.when(F.col("id") % 11 != 0, F.pow(F.col("id") % 97, F.lit(2.0))).alias("size"),
    )


@pytest.mark.parametrize("n, shards", [(0, 4), (1, 4), (3, 4), (4, 4), (1_000, 24), (997, 24), (50, 1)])
def test_shards_are_equal_and_slots_have_no_gaps(spark, n, shards):
    found = hilbert_shards(table(spark, n), ["lang", "source", "size"], shards).collect()
    assert sorted(row.doc_id for row in found) == list(range(n))
    sizes = {shard: sorted(row.slot for row in found if row.shard == shard) for shard in range(shards)}
    assert all(slots == list(range(len(slots))) for slots in sizes.values())
    assert max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1
    order = sorted(found, key=lambda row: (row.shard, row.slot))
    assert [row.curve_index for row in order] == sorted(row.curve_index for row in found)


def test_shards_do_not_depend_on_partitions(spark):
    def run(df):
        return as_dict(hilbert_shards(df, ["lang", "size"], 7), "doc_id", "shard", "slot", "curve_index")

    df = table(spark, 500)
    assert run(df) == run(df.repartition(9)) == run(df.coalesce(1))


def test_shards_can_be_skipped_by_any_dimension(spark):
    """A filter on one value meets far fewer shards than with rows dealt out at random."""
    df = hilbert_shards(table(spark, 6_000), ["lang", "source", "size"], 64).persist()
    for name, value in (("lang", "de"), ("source", "src4"), ("size", 4.0)):
        met = df.groupBy("shard").agg(F.min(name).alias("low"), F.max(name).alias("high")).where(
            (F.col("low") <= F.lit(value)) & (F.lit(value) <= F.col("high"))
        )
        assert met.count() <= 40
    df.unpersist()


@pytest.mark.parametrize("front", ["common_crawl_", "https://www.example.org/long/path/", "é" * 100])
def test_texts_with_a_common_beginning_have_cells_of_their_own(spark, front):
    """Shards can be skipped by the whole text, whatever all texts begin with."""
    df = table(spark, 6_000).withColumn("source", F.concat(F.lit(front), "source"))
    found = hilbert_shards(df, ["lang", "source", "size"], 64)
    met = found.groupBy("shard").agg(F.min("source").alias("low"), F.max("source").alias("high"))
    assert met.where((F.col("low") <= F.lit(front + "src4")) & (F.lit(front + "src4") <= F.col("high"))).count() <= 40


@pytest.mark.parametrize("sample", [100_000, 2_000])
def test_bounds_of_texts_are_quantiles(spark, sample):
    """A hot value and 9,000 others: exact if all are looked at, near otherwise."""
    values = sorted([f"https://host/{i * 7919 % 9_000:05d}" for i in range(9_000)] + ["https://host/01000x"] * 3_000)
    df = spark.createDataFrame([(value.encode(),) for value in values], "value binary").repartition(5)
    shares = [i / 32 for i in range(1, 32)]
    bounds = [bound.decode() for bound in _text_bounds(df, len(values), shares, sample)]
    for bound, share in zip(bounds, shares):
        if sample > len(values):
            assert bound == values[math.ceil(share * len(values)) - 1]
        assert bisect.bisect_left(values, bound) / len(values) - 0.05 <= share <= bisect.bisect_right(values, bound) / len(values) + 0.05


def test_equal_rows_odd_values_and_clashing_columns(spark, clashing):
    nan = float("nan")
    df = spark.createDataFrame([(None, None, None), (None, None, None), (1, "", nan), (1, "é", 0.0), (2, "x" * 40, -1.0)], "doc_id long, lang string, size double")
    df = clashing(df, "Shard", "slot", "extra")
    found = hilbert_shards(df, ["lang", "size"], 2)
    assert found.columns == ["doc_id", "lang", "size", "extra", "curve_index", "shard", "slot"]
    assert sorted((row.shard, row.slot) for row in found.collect()) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]
    one_value = hilbert_shards(spark.range(10).withColumn("c", F.lit("same")), ["c"], 3)
    assert sorted(row["count"] for row in one_value.groupBy("shard").count().collect()) == [3, 3, 4]


@pytest.mark.parametrize("kind", ["date", "timestamp", "boolean", "binary", "decimal(5,2)", "int"])
def test_dimensions_of_other_types(spark, kind):
    value = {"date": F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")), "boolean": F.col("id") > 15}.get(
        kind, F.col("id").cast("string").cast("binary") if kind == "binary" else F.col("id").cast("int").cast(kind)
    )
    df = spark.range(32).select("id", value.alias("d"))
    low = hilbert_shards(df, ["d"], 2).groupBy("shard").agg(F.min("d").alias("low"), F.max("d").alias("high")).orderBy("shard").collect()
    assert low[0].high <= low[1].low


def test_files_of_shards(spark, tmp_path):
    df = hilbert_shards(table(spark, 100), ["lang"], 4)
    write_shards(df, str(tmp_path / "s"))
    again = spark.read.parquet(str(tmp_path / "s"))
    assert rows(again.select(*df.columns)) == rows(df)
    assert [row.slot for row in spark.read.parquet(str(tmp_path / "s/shard=2")).coalesce(1).collect()] == list(range(25))


def test_no_python_and_no_cross_join(spark, plan):
    text = plan(QUERIES["op8_sharding"](spark, "/root/testdata/sf0.001"))
    for operator in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_the_query_counts_sizes_in_bytes(spark):
    sf = "/root/testdata/sf0.001"
    found = as_dict(QUERIES["op8_sharding"](spark, sf), "doc_id", "size", "text_crc32", "law", "grown_shard")
    import zlib

    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        data = (row.text or "").encode()
        assert found[row.doc_id] == (len(data) + 8, zlib.crc32(data), "rows", None)
    assert math.ceil(len(found) / 24) >= 1


def test_the_query_equals_brute_force(spark):
    """Sizes, checksums, and shard and slot from the rank of every row: by its place on the curve, then the hash of its columns."""
    import zlib

    sf = "/root/testdata/sf0.001"
    documents = {row.doc_id: row for row in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = QUERIES["op8_sharding"](spark, sf).collect()
    for row in found:
        text = (documents[row.doc_id].text or "").encode()
        assert (row.size, row.text_crc32, row.law, row.grown_shard) == (len(text) + 8, zlib.crc32(text), "rows", None)
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    keyed = spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", "lang", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    places = as_dict(hilbert_shards(keyed, ["lang", "source", "size"], 24), "doc_id", "curve_index")
    hashes = as_dict(keyed.select("doc_id", F.xxhash64(*keyed.columns).alias("h")), "doc_id", "h")
    order = sorted(places, key=lambda doc: (places[doc], hashes[doc]))
    n, longer = divmod(len(order), 24)
    cuts = [0, *itertools.accumulate(n + (shard < longer) for shard in range(24))]
    expected = {doc: (shard, slot) for shard, (a, b) in enumerate(zip(cuts, cuts[1:])) for slot, doc in enumerate(order[a:b])}
    assert {row.doc_id: (row.shard, row.slot) for row in found} == expected
    # What has one place on the curve has one language: with few values, each is a cell of its own.
    cells = {}
    for doc, place in places.items():
        cells.setdefault(place, set()).add(documents[doc].lang)
    assert all(len(own) == 1 for own in cells.values())

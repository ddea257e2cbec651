import pytest
from pyspark.sql import functions as F

from retailweave.llm import decontamination
from retailweave.llm.decontamination import decontaminate, search

from conftest import rows
from llm.conftest import ODD_TEXTS, as_dict
from llm.test_words import plain_words


def brute(text, items, window=13):
    """``(n_words, n_hit, item ids)`` by comparing every window of every item with every place."""
    words, hit, found = plain_words(text), set(), set()
    for item, item_text in items:
        own = plain_words(item_text)
        n = min(window, len(own))
        for k in range(len(own) - n + 1) if own else ():
            for i in range(len(words) - n + 1):
                if words[i : i + n] == own[k : k + n]:
                    hit.update(range(i, i + n))
                    if item is not None:
                        found.add(str(item))
    return len(words), len(hit), sorted(found)


ITEMS = [
    (1, " ".join(f"w{i}" for i in range(30))),
    (2, "Short ITEM here."),
    (10, "short item here"),
    (3, "solo"),
    (4, " ".join(["rep"] * 20)),
    (5, None),
    (6, "... --- !!!"),
    (7, " ".join(f"w{i}" for i in range(5, 18)) + " tail differs now"),
    (None, "item without an id"),
    (8, "zwei wörter"),
]
TEXTS = [
    " ".join(f"w{i}" for i in range(30)),
    "lead " + " ".join(f"w{i}" for i in range(12)) + " trail",
    "lead " + " ".join(f"W{i}!" for i in range(13)) + " trail",
    "a short-item, HERE and a short item here",
    "short item her e",
    "solo solo solos solo",
    " ".join(["rep"] * 45),
    "x " * 700 + " ".join(f"w{i}" for i in range(3, 29)) + " y" * 600,
    "an item without an id",
    "ZWEI Wörter zwei WÖRTER zwei wörter",
    *ODD_TEXTS,
]


@pytest.mark.parametrize("part_bytes", [decontamination.PART_BYTES, 60, 1])
def test_equals_brute_force(spark, texts, part_bytes):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = as_dict(search(texts(TEXTS), benchmark, part_bytes=part_bytes), "doc_id", "n_words", "n_hit", "item_ids")
    for i, text in enumerate(TEXTS):
        if text is None or len(text) < 20_000:
            assert found[i] == brute(text, ITEMS), text


def test_spans_cover_the_hit_words(spark, texts):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    for row in search(texts(TEXTS), benchmark).collect():
        ends = row.hit_spans
        assert sum(b - a for a, b in zip(ends[::2], ends[1::2])) == row.n_hit
        assert ends == sorted(set(ends))


def test_windows_do_not_cross_texts(spark, texts):
    words = [f"w{i}" for i in range(13)]
    benchmark = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    df = texts([" ".join(words[:6]), " ".join(words[6:])]).coalesce(1)
    assert [row.n_hit for row in search(df, benchmark).collect()] == [0, 0]


def test_no_benchmark_and_no_documents(spark, texts):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert as_dict(search(texts(["a b", None]), benchmark), "doc_id", "n_words", "n_hit", "item_ids") == {0: (2, 0, []), 1: (0, 0, [])}
    assert search(texts([]), spark.createDataFrame(ITEMS, "item_id long, text string")).collect() == []


def test_contaminated_documents_go_with_their_columns_kept(spark, texts, clashing):
    benchmark = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    passage = " ".join(f"w{i}" for i in range(13))
    values = [passage + " x" * 247, passage + " x" * 248, None, "", "clean"]
    df = clashing(texts(values), "n_hit", "N_WORDS", "row", "item_ids")
    kept = decontaminate(df, benchmark)
    assert kept.columns == df.columns
    assert rows(kept) == rows(df.where("doc_id <> 0"))


def test_repeated_rows_are_all_judged(spark, texts):
    df = texts(["w0"] * 3).withColumn("doc_id", F.lit(None).cast("long"))
    benchmark = spark.createDataFrame([(1, "w0"), (1, "w0")], "item_id long, text string")
    assert [(row.doc_id, row.n_hit, row.item_ids) for row in search(df, benchmark).collect()] == [(None, 1, ["1"])] * 3


def test_a_large_benchmark_is_held_part_by_part(spark, texts, monkeypatch, plan):
    """A hundred parts: one step of Python, parts that are loaded once for all slices, and nothing for the driver."""
    items = [(i, " ".join(f"b{i}x{k}" for k in range(40))) for i in range(400)]
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(5)
    size = sum(len(text) for _, text in items)
    values = [f"some words {items[i][1]} and more" if i % 3 else f"clean {i}" for i in range(300)]
    df = search(texts(values), benchmark, part_bytes=size // 100)
    assert plan(df).count("MapInArrow") == 1
    found = as_dict(df, "doc_id", "n_hit", "item_ids")
    assert found == {i: (40, [str(i)]) if i % 3 else (0, []) for i in range(300)}
    parts = decontamination.benchmark_parts(benchmark, "item_id", "text", 13, size // 100)
    assert 90 <= len(parts) <= 101

    from retailweave.llm.batches import add_columns_by_parts

    loads = spark.sparkContext.accumulator(0)

    class Counting(decontamination._Visitor):
        def load(self, part):
            loads.add(1)
            return super().load(part)

    one = texts(values).coalesce(1)
    add_columns_by_parts(one, "text", decontamination._STATE, lambda: Counting(13), parts).collect()
    assert loads.value == len(parts)


def test_items_longer_than_a_piece_keep_every_window(spark, texts, monkeypatch):
    words = [f"long{k}" for k in range(500)]
    benchmark = spark.createDataFrame([(1, " ".join(words)), (2, "x" * 300)], "item_id long, text string")
    values = [" ".join(words[k : k + 13]) for k in range(0, 488)] + ["x" * 300]
    found = search(texts(values), benchmark, part_bytes=100).collect()
    assert {row.n_hit for row in found if row.doc_id < 488} == {13} and {tuple(row.item_ids) for row in found} == {("1",), ("2",)}


def test_windows_that_many_items_share_are_one_pattern():
    import pyarrow as pa

    from retailweave.llm.decontamination import pattern_sets

    (patterns,) = pattern_sets(pa.array([" ".join(f"w{k}" for k in range(20))] * 50))
    assert len(patterns.begin) == 8 and patterns.items(0).tolist() == list(range(50))

import random

import pytest
from pyspark.sql import functions as F

from retailweave.llm.components import components
from retailweave.llm.jaccard_join import choose_bands, drop_near_duplicates, similarity_join

from conftest import rows
from llm.conftest import ODD_TEXTS, as_dict
from llm.test_words import plain_words


def brute(values, n=5, threshold=0.8):
    """``{i: (class, links)}`` by comparing all pairs."""
    sets = []
    for text in values:
        words = plain_words(text)
        sets.append({tuple(words[k : k + n]) for k in range(max(len(words) - n + 1, 1))} if words else set())
    links = {i: set() for i in range(len(values))}
    for i in range(len(values)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-12:
                links[i].add(j)
                links[j].add(i)
    root = {}
    for i in links:
        stack, seen = [i], {i}
        while stack:
            for k in links[stack.pop()] - seen:
                seen.add(k)
                stack.append(k)
        root[i] = min(seen)
    return {i: (root[i], len(links[i])) for i in links}


def corpus(seed=1, groups=12, words=60):
    """Documents with exact copies and copies with one word to a third of the words changed."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    out = []
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(words)]
        for copy in range(rng.choice([1, 2, 5, 12])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                own[rng.randrange(words)] = f"x{rng.randrange(1000)}"
            out.append(" ".join(own))
    return out


@pytest.mark.parametrize("block_rows", [256, 4])
def test_equals_brute_force(texts, block_rows):
    """Large groups are cut into blocks of four, so links between blocks are found as well."""
    values = corpus() + ["short text", "Short, text", "short text too", None, "", "...", "only", "only"]
    found = as_dict(similarity_join(texts(values), block_rows=block_rows), "doc_id", "class_id", "n_links")
    assert found == brute(values)


def test_a_chain_is_one_class(texts):
    """Each text is near the next and far from the one after."""
    words = [f"w{i}" for i in range(200)]
    values = [" ".join(words[i * 9 : i * 9 + 100]) for i in range(8)]
    expected = brute(values)
    assert {c for c, _ in expected.values()} == {0} and max(n for _, n in expected.values()) == 2
    assert as_dict(similarity_join(texts(values)), "doc_id", "class_id", "n_links") == expected


def test_a_large_group_of_near_copies_is_linked_in_full(spark):
    """600 different texts, each near all others: 179,700 links, and no row for a pair."""
    base = " ".join(f"w{i}" for i in range(100))
    df = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(F.lit(base + " z"), "id").alias("text"))
    found = similarity_join(df, block_rows=64)
    assert found.groupBy("class_id", "n_links").count().collect() == [(0, 599, 600)]


def test_at_the_threshold(texts):
    """Eight common n-grams of ten are linked, eight of eleven are not."""
    same = [f"w{i}" for i in range(12)]
    values = [" ".join(same + ["x"]), " ".join(same + ["y"]), " ".join(["p", *same[:-1], "q"]), " ".join(same[2:])]
    assert as_dict(similarity_join(texts(values)), "doc_id", "class_id", "n_links") == brute(values)


def test_odd_texts(texts):
    values = [*ODD_TEXTS, *ODD_TEXTS]
    assert as_dict(similarity_join(texts(values)), "doc_id", "class_id", "n_links") == brute(values)


def test_null_ids_repeated_rows_and_no_rows(spark, texts):
    df = spark.createDataFrame([(None, "a b c"), (3, "a b c"), (3, "a b c"), (None, "other"), (None, None)], "doc_id long, text string")
    assert rows(similarity_join(df)) == sorted(
        [(3, 3, 2), (3, 3, 2), (None, 3, 2), (None, None, 0), (None, None, 0)], key=repr
    )
    assert similarity_join(texts([])).collect() == []


def test_ids_of_other_types_and_clashing_columns(spark):
    df = spark.createDataFrame([("b", "x y z", 1), ("a", "X y z", 2)], "doc_id string, text string, class_id int").withColumn("node", F.lit(1))
    assert rows(similarity_join(df)) == [("a", "a", 1), ("b", "a", 1)]


def test_one_row_of_every_class_stays(texts, clashing):
    values = corpus(2) + [None, None, "", "..."]
    df = clashing(texts(values), "class_id", "n_links", "node", "id")
    kept = drop_near_duplicates(df)
    expected = {i for i, (c, _) in brute(values).items() if i == c}
    assert kept.columns == df.columns and {row.doc_id for row in kept.collect()} == expected
    assert rows(kept) == rows(df.where(F.col("doc_id").isin(expected)))


def test_repeated_rows_are_one(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "A b c"), (None, "n"), (None, "n")], "doc_id long, text string")
    assert rows(drop_near_duplicates(df)) == [(1, "a b c"), (None, "n")]


def test_band_choice_reaches_the_recall():
    for threshold in (0.5, 0.8, 0.95):
        for recall in (0.9, 0.999):
            bands, n_rows = choose_bands(threshold, recall, 64)
            assert 1 - (1 - threshold**n_rows) ** bands >= recall and bands <= 64


def test_measured_recall_at_the_threshold(texts):
    """Of 300 pairs a little above the threshold all but very few are found."""
    values = []
    for g in range(300):
        base = [f"g{g}w{i}" for i in range(100)]
        other = list(base)
        other[50] = "changed"
        other[10] = "changed"
        values += [" ".join(base), " ".join(other)]
    expected = brute(values[:2])
    assert expected[0][1] == 1
    found = as_dict(similarity_join(texts(values)), "doc_id", "n_links")
    assert sum(found.values()) >= 2 * 0.99 * 300


@pytest.mark.parametrize("n", [1, 2, 50])
def test_components_of_a_path_and_a_star(spark, n):
    path = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(n).select(F.lit(1000).cast("long").alias("a"), (F.col("id") + 1001).alias("b"))
    odd = spark.createDataFrame([(5000, 5000), (None, 1), (7, None)], "a long, b long")
    found = as_dict(components(path.union(star).union(odd).union(star)), "node", "root")
    assert found == {**{i: 0 for i in range(n + 1)}, **{1000 + i: 1000 for i in range(n + 1)}}


def test_components_of_random_links_equal_brute_force(spark):
    rng = random.Random(3)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(55)]
    label = {x: x for pair in links for x in pair}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    in_links = {x for a, b in links if a != b for x in (a, b)}
    found = as_dict(components(spark.createDataFrame(links, "a long, b long")), "node", "root")
    assert found == {x: label[x] for x in in_links}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []

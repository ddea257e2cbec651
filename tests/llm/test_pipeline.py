"""The stages of the pipeline, and what all queries of this subpackage have in common."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from retailweave.llm import decontamination, jaccard_join, language, toxicity
from retailweave.llm.oracles import ORACLES
from retailweave.llm.queries import QUERIES

from conftest import rows
from llm.test_decontamination import brute as brute_hits
from llm.test_jaccard_join import brute as brute_classes

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def comparable(table):
    names = sorted(table.column_names)
    return names, [str(table.schema.field(x).type) for x in names], sorted(zip(*(table[x].to_pylist() for x in names)), key=repr)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, sql, name):
    assert comparable(QUERIES[name](spark, SF).toArrow()) == comparable(sql.sql(ORACLES[name]).to_arrow_table())


def test_registration():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= contract.queries().keys() and ORACLES.items() <= contract.oracle_sql().items()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "near_duplicates", "decontamination", "sentence_pieces"]


def kept_by_brute_force(spark, folder):
    """Ids that each stage keeps: models as learned, everything else by comparing all with all."""
    documents = {row.doc_id: row.text for row in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    frame = lambda: spark.createDataFrame(list(documents.items()), "doc_id long, text string")
    steps = []

    labels = {row.doc_id: row.toxic for row in spark.read.parquet(f"{folder}/labels.parquet").collect() if row.toxic is not None}
    known = spark.createDataFrame([(i, text, labels[i]) for i, text in documents.items() if i in labels], "doc_id long, text string, toxic int")
    matcher = toxicity.Matcher(toxicity.learn(known))
    coefficients = matcher.coefficients
    documents = {i: text for i, text in documents.items() if sum(a * b for a, b in zip(matcher.features(text), coefficients)) < 0}
    steps.append(set(documents))

    documents = {i: text for i, text in documents.items() if any(c.isalpha() for c in text or "")}
    steps.append(set(documents))

    ids = sorted(documents)
    classes = brute_classes([documents[i] for i in ids])
    documents = {i: documents[i] for k, i in enumerate(ids) if classes[k][0] == k}
    steps.append(set(documents))

    items = [(row.item_id, row.text) for row in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    windows = decontamination.search(frame(), spark.createDataFrame(items, "item_id long, text string"))
    for row in windows.sample(0.2, 1).where("n_words < 400").collect():
        assert (row.n_words, row.n_hit, row.item_ids) == brute_hits(row.text, items)
    dirty = {row.doc_id for row in windows.collect() if row.n_hit and 20 * row.n_hit >= row.n_words}
    steps.append(set(documents) - dirty)
    return steps


def test_stages_keep_what_brute_force_keeps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for (name, stage), expected in zip(corpus_pipeline.STAGES, kept_by_brute_force(spark, SF)):
        docs = corpus_pipeline.written(stage(spark, docs, SF))
        assert docs.columns == columns, name
        assert {row.doc_id for row in docs.collect()} == expected, name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert rows(last.select(*columns)) == rows(docs)
    assert last.where(F.size("piece_ids") == 0).count() == 0
    assert {row.doc_id for row in contract.queries()["pipeline"](spark, SF).collect()} == expected


def test_stages_take_no_documents_and_odd_ones(spark, tmp_path):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    odd = [(1, None, None, None, None), (None, "", "en", "s", 0), (3, "...", None, None, 3), (4, "a word", "en", "s", 6), (4, "a word", "en", "s", 6)]
    for table, kept in (([], 0), (odd, 1)):
        docs = spark.createDataFrame(table, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, SF))
        assert docs.count() == kept


@pytest.mark.parametrize("labels", [[], [(1, None), (2, None)], [(99, 1), (98, 0)], [(1, 1), (2, 1)], [(1, 0)]])
def test_stages_that_learned_nothing_reject_nothing_but_texts_without_a_letter(spark, tmp_path, labels):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    docs = spark.createDataFrame([(1, "a word", None, None, 6), (2, "you moron", None, None, 9), (3, "1 + 2", None, None, 5), (4, None, None, None, 0)], schema)
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    clean = corpus_pipeline.not_toxic(spark, docs, str(tmp_path))
    assert rows(clean) == rows(docs)
    known = corpus_pipeline.known_language(spark, clean, str(tmp_path))
    assert known.columns == docs.columns and [row[0] for row in rows(known)] == [1, 2]


def test_the_language_stage_fills_in_what_the_profiles_say(spark, monkeypatch):
    """Documents without a language get that of the nearest profile; swapped profiles give the other one."""
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    samples = {"en": "the quick brown fox and the lazy dog went there", "fr": "le renard brun et le chien paresseux sont allés là"}
    rows_of = [(i, text, lang, "s", len(text)) for i, (lang, text) in enumerate(samples.items())]
    rows_of += [(10, "the dog went there", None, "s", 0), (11, "le chien et le renard", None, "s", 0), (12, "le chien", "en", "s", 0), (13, "1 2 3", None, "s", 0), (14, "42", "en", "s", 0)]
    docs = spark.createDataFrame(rows_of, schema)
    found = {row.doc_id: row.lang for row in corpus_pipeline.known_language(spark, docs, SF).collect()}
    assert found == {0: "en", 1: "fr", 10: "en", 11: "fr", 12: "en"}
    learned = language.learn

    def swapped(*args, **options):
        profiles = learned(*args, **options)
        return language.Profiles(profiles.languages, profiles.ngrams[::-1])

    monkeypatch.setattr(language, "learn", swapped)
    found = {row.doc_id: row.lang for row in corpus_pipeline.known_language(spark, docs, SF).collect()}
    assert found == {0: "en", 1: "fr", 10: "fr", 11: "en", 12: "en"}


def test_the_language_stage_looks_at_every_whole_text(spark, monkeypatch):
    """Documents with a language are identified as well, and all of their text is."""
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    long = "the dog went there " * 50_000 + "le chien"
    docs = spark.createDataFrame([(1, "the lazy dog", "en", "s", 0), (2, long, "en", "s", 0), (3, "le chien", None, "s", 0), (4, "4", "en", "s", 0), (5, None, "en", "s", 0)], schema)
    seen = []
    identify = language.identify

    def watched(df, profiles, text="text", keep=None):
        seen.extend((row['__others'].doc_id, row.text) for row in df.select("__others", F.col(text).alias("text")).collect())
        return identify(df, profiles, text, keep)

    monkeypatch.setattr(language, "identify", watched)
    found = corpus_pipeline.known_language(spark, docs, SF).select("doc_id", "text").collect()
    assert sorted(seen) == [(1, "the lazy dog"), (2, long), (3, "le chien"), (4, "4"), (5, None)]
    assert sorted(tuple(row) for row in found) == [(1, "the lazy dog"), (2, long), (3, "le chien")]


def test_nothing_else_imports_this_subpackage():
    import pathlib
    import re

    root = pathlib.Path(contract.__file__).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.parts and path.name not in ("__spark_entry__.py", "corpus_pipeline.py"):
            assert not re.search(r"retailweave\.llm|import llm|corpus_pipeline", path.read_text()), path


def test_models_are_the_production_ones():
    assert jaccard_join.NGRAM == 5 and jaccard_join.THRESHOLD == 0.8 and language.UNKNOWN == "und"


def test_stages_keep_columns_named_like_results(spark):
    """Extra columns with the operators' own names go through all filtering stages as they are."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ("score", "Predicted", "lang_pred", "n_hit", "class_id", "node", "id", "__kept")
    extra = docs.withColumns({name: F.concat(F.lit(name), "doc_id") for name in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs, extra = (corpus_pipeline.written(stage(spark, df, SF)) for df in (docs, extra))
        assert extra.columns == [*docs.columns, *names]
    assert rows(extra.select(*docs.columns)) == rows(docs)
    assert extra.where(" or ".join(f"`{name}` <> concat('{name}', doc_id)" for name in names)).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, extra, SF).count() == docs.count()

"""Cleaning of a corpus in stages. Each takes the documents that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailweave.llm import decontamination, jaccard_join, language, sentence_pieces, toxicity
from retailweave.llm.batches import packed, unpacked
from retailweave.llm.queries import PIECE_MODEL
from retailweave.session import ship_package
from retailweave.sinks.scratch import written


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score below 0.5, by a model of all that have a label.

    All documents, if no term tells toxic ones from others: without labels, or with one label only.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic is not null").select("doc_id", "toxic")
    model = toxicity.learn(toxicity.labelled(docs.select("doc_id", "text"), labels))
    if not model.terms and not model.files:
        return docs
    scored = toxicity.score_toxicity(packed(docs, "text"), model, "__text")
    return unpacked(scored.where("predicted = 0"), docs.columns, "text")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which a language can be told: those with a letter, whether or not any language is known.

    Every whole text is compared with the profiles of all documents that have a language, or with ``ANY`` where none has.
    Documents without a language get the predicted one as their ``lang``; those with a language keep it.
    """
    profiles = language.learn(docs)
    found = language.identify(packed(docs, "text"), profiles if profiles.languages else language.ANY, "__text")
    kept = found.where(F.col("lang_pred") != language.UNKNOWN)
    if profiles.languages:
        lang = F.coalesce(F.col("__others")["lang"], F.col("lang_pred"))
        kept = kept.withColumn("__others", F.col("__others").withField("lang", lang))
    return unpacked(kept, docs.columns, "text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, the one with the smallest id."""
    return jaccard_join.drop_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not contaminated with benchmark items."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with a sampled segmentation, ``piece_ids``, and the text that it decodes to."""
    vocabulary = sentence_pieces.read_vocabulary(PIECE_MODEL)
    pieces = sentence_pieces.round_trip(docs, vocabulary, keep=[name for name in docs.columns if name != "text"])
    return pieces.withColumnRenamed("decoded", "text")


STAGES = [
    ("toxicity", not_toxic),
    ("language_id", known_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("sentence_pieces", encoded),
]

# Learned models and MinHash are not expressed in SQL; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, on ``documents``. Each result is written and read again.

    Within ``run_folder`` all intermediate tables go when the caller is done with the result.
    """
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

import pytest
from pyspark.sql import functions as F

from retailweave.session import ship_package


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def texts(spark):
    """A frame of ``(doc_id, text)`` from a list of texts, over several partitions."""

    def make(values, schema="doc_id long, text string"):
        return spark.createDataFrame(list(enumerate(values)), schema).repartition(3)

    return make


@pytest.fixture
def clashing():
    """The frame with one more column for each name, of a type of its own."""

    def add(df, *names):
        return df.withColumns({name: F.array(F.lit(f"own {name}")) for name in names})

    return add


def as_dict(df, key, *columns):
    """Rows by key, as a tuple of the columns or the one column."""
    return {row[key]: row[columns[0]] if len(columns) == 1 else tuple(row[c] for c in columns) for row in df.collect()}


#: Texts that every operator on texts has to take.
ODD_TEXTS = [None, "", " ", "\n\t", "...", "word", "Ünïcödé wörds 日本語", "\u0000\u0001", "🎉🎉", "a" * 30_000, "one two " * 20_000]

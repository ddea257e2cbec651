"""Toxicity by a weighted lexicon that is matched with Aho-Corasick on folded text.

Folding: lower case, homoglyphs, digit substitutions and compatibility forms of any code point become
the letters they stand for, accents and invisible characters go, other letters stay, and everything else is a space. The lexicon has whole words and
beginnings of words, each with the log-odds of its documents' labels; it is learned
from counts over all training rows and has every term that passes the thresholds. One of
more than ``CHUNK_TERMS`` terms is a written table, of which a task holds a part at a time, over many slices of
texts (``batches.add_columns_by_parts``); all terms that can match at a place are in the same part. Matches inside an exception phrase do not
count. What is left is summed up, set in proportion to the length, and mapped to a
score from 0 to 1 by a logistic regression on four numbers.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailweave.llm.batches import add_columns_by_parts, quoted
from retailweave.operators.joins import measured_bytes
from retailweave.sinks.scratch import written

PREFIX_LENGTHS = (4, 5, 6)
MIN_TOXIC = 5  # training documents that a term must mark
MIN_WEIGHT = 1.5  # least log-odds, and 1.96 standard errors less
CHUNK_TERMS = 200_000  # terms that are in memory at a time, about
FIT_ROWS = 20_000  # rows of each label that the regression is fitted on, about
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

_FLUSH = 200_000  # terms
_FLUSH_LETTERS = 1 << 25  # of terms longer than ``_LONG``
_LONG = 30

# Characters that look like letters, with the letters.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "ј": "j", "к": "k", "м": "m",
    "т": "t", "н": "h", "в": "b", "α": "a", "ε": "e", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "ν": "v", "ι": "i", "κ": "k",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
}

# Phrases whose words are no insult there, in folded form.
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "clown fish", "clown car", "circus clown", "idiot proof", "pond scum",
    "sore loser", "stupid mistake", "pathetic fallacy", "scum line",
)


class _Fold(dict):
    """What each character becomes, for ``str.translate``; filled as characters occur."""

    def __missing__(self, code: int) -> str:
        self[code] = found = _fold_character(chr(code))
        return found


def _fold_character(char: str) -> str:
    if unicodedata.combining(char) or unicodedata.category(char) == "Cf" or char in _SELECTORS:
        return ""
    plain = unicodedata.normalize("NFKD", char.lower()).lower()
    letters = HOMOGLYPHS.get(char.lower()) or "".join(HOMOGLYPHS.get(c, c) for c in plain if not unicodedata.combining(c))
    # Syllables that NFKD takes apart are put together again, and letters are taken out of brackets.
    words = unicodedata.normalize("NFC", letters).strip("()").split()
    return " ".join(words) if words and all(word.isalpha() for word in words) else " "


# Marks without a width that choose a form of the character before.
_SELECTORS = {chr(code) for code in [0x34F, *range(0x180B, 0x180E), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)]}
_FOLD = _Fold()
_ASCII_FOLD = bytes(ord(_FOLD[code]) for code in range(128)) + bytes(range(128, 256))


def folded(text: str) -> str:
    """The folded text. Characters of scripts without an ASCII likeness stay."""
    if text.isascii():
        return text.encode().translate(_ASCII_FOLD).decode()
    return text.translate(_FOLD)


@dataclass(frozen=True)
class Model:
    terms: tuple[tuple[str, float], ...]
    """Folded terms, with a space before (word beginnings) or on both sides (words), and their weights."""
    coefficients: tuple[float, ...]
    exceptions: tuple[str, ...] = EXCEPTIONS
    files: tuple[str, ...] = ()
    """The parts of a lexicon that is too large for ``terms``, as Parquet files in the shared folder."""


def _read_terms(file: str) -> Iterator[tuple[str, float]]:
    system, path = fs.FileSystem.from_uri(file)
    with system.open_input_file(path) as source:
        table = pq.ParquetFile(source).read(["term", "weight"])
    yield from zip(table["term"].to_pylist(), table["weight"].to_pylist())


class Matcher:
    """Sums up texts' lexicon matches, part of the lexicon by part."""

    def __init__(self, model: Model):
        self.model = model
        self.coefficients = np.asarray(model.coefficients)
        self._whole: ahocorasick.Automaton | None = None

    @property
    def parts(self) -> tuple[str, ...]:
        """What ``load`` takes: the files of the lexicon, or one empty name for the terms that the model has itself."""
        return self.model.files or ("",)

    def load(self, part: str) -> ahocorasick.Automaton:
        automaton = ahocorasick.Automaton()
        for term, weight in _read_terms(part) if part else self.model.terms:
            automaton.add_word(term, (len(term), weight, term))
        for phrase in self.model.exceptions:
            automaton.add_word(f" {phrase} ", (len(phrase) + 2, None, phrase))
        if len(automaton):
            automaton.make_automaton()
        return automaton

    def begin(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """The folded texts, and for each the weight of its matches and of the distinct terms among them."""
        plain = [f" {folded(text or '')} " for text in texts.to_pylist()]
        return plain, np.zeros((len(plain), 2))

    def visit(self, automaton: ahocorasick.Automaton, texts: pa.Array, state: tuple[list[str], np.ndarray]) -> None:
        plain, sums = state
        for row, text in enumerate(plain):
            found = _matches(automaton, text)
            if found:
                distinct = {term: weight for _, _, weight, term in found}
                sums[row] += sum(match[2] for match in found), sum(distinct.values())

    def _rows(self, state: tuple[list[str], np.ndarray]) -> np.ndarray:
        plain, sums = state
        n_words = np.array([text.count(" ") + 1 for text in plain], dtype=np.float64)
        return np.stack([np.log1p(100 * sums[:, 0] / n_words), np.log1p(sums[:, 1]), np.log1p(n_words), np.ones(len(plain))], axis=1)

    def scores(self, texts: pa.Array) -> np.ndarray:
        return self._scores(self.features_of(texts.to_pylist()))

    def _scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ self.coefficients, -30, 30)))

    def end(self, texts: pa.Array, state: tuple[list[str], np.ndarray]) -> list[pa.Array]:
        scores = self._scores(self._rows(state))
        return [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]

    def matches(self, text: str) -> list[tuple[int, int, float, str]]:
        """``(start, end, weight, term)`` in ``text``, which is folded: the strongest term of every word."""
        return [match for part in self.parts for match in _matches(self._loaded(part), text)]

    def _loaded(self, part: str) -> ahocorasick.Automaton:
        """A part for calls about single texts; that of a lexicon without files is kept."""
        if part:
            return self.load(part)
        if self._whole is None:
            self._whole = self.load(part)
        return self._whole

    def features(self, text: str | None) -> tuple[float, float, float, float]:
        """Weight in proportion to length, weight of the distinct terms, both on a log scale, log length, 1."""
        return tuple(self.features_of([text])[0].tolist())

    def features_of(self, texts: list[str | None]) -> np.ndarray:
        """A row of features for each text."""
        texts = pa.array(texts, pa.string())
        state = self.begin(texts)
        for part in self.parts:
            self.visit(self._loaded(part), texts, state)
        return self._rows(state)


class _Features(Matcher):
    """A matcher whose results are the features themselves."""

    def end(self, texts: pa.Array, state: tuple[list[str], np.ndarray]) -> list[pa.Array]:
        return [pa.array(column) for column in self._rows(state).T]


def _matches(automaton: ahocorasick.Automaton, text: str) -> list[tuple[int, int, float, str]]:
    if not len(automaton):
        return []
    found, exceptions = {}, []
    for last, (length, weight, term) in automaton.iter(text):
        start = last + 1 - length
        if weight is None:
            exceptions.append((start, last + 1))
        elif start not in found or weight > found[start][2]:
            found[start] = (start, last + 1, weight, term)
    if exceptions:
        inside = np.zeros(len(text) + 1, dtype=np.int32)
        for start, end in exceptions:
            inside[start] += 1
            inside[end - 1] -= 1
        covered = np.cumsum(inside) > 0
        return [match for match in found.values() if not covered[match[0]]]
    return list(found.values())


def _terms(text: str | None) -> set[str]:
    """Every term that a text could put into the lexicon, once."""
    words = {word for word in folded(text or "").split() if len(word) > 2}
    return {f" {word} " for word in words} | {f" {word[:n]}" for n in PREFIX_LENGTHS for word in words if len(word) > n}


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of toxic and other documents by term, summed up for as many rows as memory holds."""
    toxic, other, letters = Counter(), Counter(), 0

    def flush():
        names = list(toxic.keys() | other.keys())
        columns = [pa.array(names, pa.string()), pa.array([toxic[x] for x in names], pa.int64()), pa.array([other[x] for x in names], pa.int64())]
        toxic.clear()
        other.clear()
        return pa.RecordBatch.from_arrays(columns, ["term", "toxic", "other"])

    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            terms = _terms(text.as_py())
            (toxic if label else other).update(terms)
            letters += sum(len(term) for term in terms if len(term) > _LONG)
            if len(toxic) + len(other) > _FLUSH or letters > _FLUSH_LETTERS:
                yield flush()
                letters = 0
    yield flush()


def labelled(documents: DataFrame, labels: DataFrame, key: str = "doc_id", max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """The documents with a label. The labels are broadcast if they measure at most ``max_broadcast_bytes``.

    Larger ones are joined by a shuffle, whose result is written, as ``learn`` reads it several times.
    """
    if measured_bytes([labels])[0] <= max_broadcast_bytes:
        return documents.join(F.broadcast(labels), key)
    return written(documents.join(labels, key))


def learn(
    rows: DataFrame,
    label: str = "toxic",
    text: str = "text",
    key: str = "doc_id",
    exceptions: tuple[str, ...] = EXCEPTIONS,
    fit_rows: int = FIT_ROWS,
    chunk_terms: int = CHUNK_TERMS,
) -> Model:
    """The lexicon and the regression from all ``rows`` with a label 0 or 1; others say nothing.

    The counts behind the weights cover all rows. The regression is fitted on a sample of about
    ``fit_rows`` rows of each label, drawn by the hash of ``key`` and weighted back to their
    numbers. Without rows of both labels there is no lexicon and every text gets the one label.
    A lexicon of more than ``chunk_terms`` terms stays in files; the driver does not see it.
    """
    known = rows.select(
        quoted(label).cast("int").alias("label"), quoted(text).cast("string").alias("text"), quoted(key).alias("key")
    ).where("label in (0, 1)")
    totals = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    n_toxic, n_other = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_other:
        return Model((), (0.0, 0.0, 0.0, 1.0 if n_toxic else -1.0 if n_other else 0.0), exceptions)
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("other") + 0.5) / (n_other + 1.0))
    weight = odds - 1.96 * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("other") + 0.5))
    lexicon = written(
        known.select("label", "text").mapInArrow(_count_terms, "term string, toxic long, other long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .where(F.col("toxic") >= MIN_TOXIC)
        .select("term", weight.alias("weight"))
        .where(F.col("weight") >= MIN_WEIGHT)
    )
    n_terms, terms, files = lexicon.count(), (), ()
    if n_terms <= chunk_terms:
        terms = tuple(sorted((row.term, float(row.weight)) for row in lexicon.collect()))
    else:
        # Terms that can match at the same place agree in the space and the four characters that they begin with.
        parts = lexicon.repartition(-(-n_terms // chunk_terms), F.substring("term", 1, 5))
        files = tuple(sorted(written(parts).inputFiles()))
    matcher_of = known.sparkSession.sparkContext.broadcast(Model(terms, (0.0,) * 4, exceptions, files))

    # Texts are not moved for the sample: a row is in it if the hash of its key is small enough.
    part = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) / float(1 << 20)
    sample = known.where(part < F.when(F.col("label") == 1, fit_rows / n_toxic).otherwise(fit_rows / n_other))
    names = ["a", "b", "c", "d"]
    schema = T.StructType([T.StructField(name, T.DoubleType()) for name in names])
    parts = _Features(Model(terms, (), exceptions, files)).parts
    table = add_columns_by_parts(sample.select("label", "text"), "text", schema, lambda: _Features(matcher_of.value), parts, ["label"]).toPandas()
    drawn = table["label"].value_counts()
    shares = table["label"].map({1: n_toxic / drawn.get(1, 1), 0: n_other / drawn.get(0, 1)}).to_numpy()
    return Model(terms, _logistic(table[names].to_numpy(), table["label"].to_numpy(), shares), exceptions, files)


def _logistic(x: np.ndarray, y: np.ndarray, shares: np.ndarray) -> tuple[float, ...]:
    """Coefficients of a lightly regularised logistic regression, by Newton steps."""
    w = np.zeros(x.shape[1])
    shares = shares / shares.mean()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (shares * (p - y)) + 0.1 * w
        hessian = (x * (shares * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


ADDED = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def score_toxicity(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``score`` (0 to 1) and ``predicted`` (1 if the score is at least 0.5) of every whole text.

    Null and empty texts have no match and get the score of such a text. The columns ``keep``
    (all by default) stay; those named like a result are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    return add_columns_by_parts(df, text, ADDED, lambda: Matcher(shared.value), Matcher(model).parts, keep)

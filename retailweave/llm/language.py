"""Language identification by rank-order profiles of character n-grams.

A profile is the list of a language's most frequent n-grams of one to three letters,
by rank. A text is compared with each profile by out-of-place distance: for every
one of its own most frequent n-grams, how far its rank in the text is from its rank
in the profile, or the profile's length if it is not there.

N-grams are 64-bit numbers: every letter is lower-cased and becomes a symbol of 21 bits, its code point
and two, so that the letters of all scripts have symbols of their own. The space before and after a word is a symbol as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from retailweave.llm.batches import add_columns, pieces, quoted, text_bytes

PROFILE = 400  # n-grams of a profile
UNKNOWN = "und"

MAX_LANGUAGES = 10_000  # whose profiles are in memory; more values of the language column are an error

SLICE_BYTES = 1 << 17  # of text whose n-grams are in memory at a time, at some 150 bytes for each

_SALTS = 16
_FLUSH = 1_000_000
_SPACE = 1
_BITS = 21


@cache
def _symbols() -> np.ndarray:
    """The symbol of every code point: 0 for what is no letter, and that of its lower case, beyond 1, for a letter."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            table[code] = ord(char.lower()[0]) + 2
    return table


def _ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the texts and the text of each, in order of the texts."""
    joined = "\n".join(text or "" for text in texts)
    # Unpaired surrogates cannot occur in UTF-8 input.
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    symbols = _symbols()[codes].astype(np.uint64)
    lengths = np.array([len(text or "") for text in texts], dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths + 1)[: len(codes)]
    # One space symbol stands for everything between two words; a text begins and ends with one.
    letter = symbols > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    symbols, owner = np.where(letter, symbols, _SPACE)[keep], owner[keep]
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    # The first word of a text has no space of its own before it; one is put in.
    symbols = np.insert(symbols, first, _SPACE)
    owner = np.insert(owner, first, owner[first])
    # The symbol after a text's last letter is the line break in between, or nothing at the very end.
    if len(symbols) and symbols[-1] != _SPACE:
        symbols, owner = np.append(symbols, np.uint64(_SPACE)), np.append(owner, owner[-1])
    # No symbol of a letter or space is 0, so shorter n-grams are smaller numbers than longer ones.
    one, bits = symbols, np.uint64(_BITS)
    two = (symbols[:-1] << bits | symbols[1:]) if len(symbols) > 1 else symbols[:0]
    three = (two[:-1] << bits | symbols[2:]) if len(two) > 1 else symbols[:0]
    grams = np.zeros((len(one), 3), dtype=np.uint64)
    grams[:, 0] = np.where(one == _SPACE, 0, one)
    grams[: len(two), 1] = np.where(owner[: len(two)] == owner[1:], two, 0)
    grams[: len(three), 2] = np.where(owner[: len(three)] == owner[2:], three, 0)
    flat, owners = grams.reshape(-1), np.repeat(owner, 3)
    real = flat > 0
    return flat[real], owners[real]


def _ranked(grams: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` most frequent n-grams, by rank; ties by number."""
    values, times = np.unique(grams, return_counts=True)
    if len(values) > most:
        least = np.partition(times, len(times) - most)[len(times) - most]
        kept = times >= least
        values, times = values[kept], times[kept]
    return values[np.argsort(-times, kind="stable")[:most]]


@dataclass(frozen=True)
class Profiles:
    languages: tuple[str, ...]
    ngrams: tuple[tuple[int, ...], ...]


ANY = Profiles(("any",), ((),))  # one language without n-grams, which every text with a letter is nearest to


def learn(
    rows: DataFrame, language: str = "lang", text: str = "text", size: int = PROFILE, max_languages: int = MAX_LANGUAGES
) -> Profiles:
    """The profile of every value of ``language``, from counts over all rows and whole texts.

    Rows without a language or text say nothing. A language whose texts have no letter has
    an empty profile and is never predicted. More than ``max_languages`` of them are an error. ``size`` n-grams of each reach the driver.
    """
    known = rows.select(quoted(language).cast("string").alias("language"), quoted(text).cast("string").alias("text")).where(
        "language is not null and text is not null"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Numbers of n-grams by language, summed up for as many texts as memory holds."""
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def flush():
            names = pa.array(list(held), pa.string()).take(pa.array(np.repeat(np.arange(len(held)), [len(x) for x, _ in held.values()])))
            grams, times = (np.concatenate([np.zeros(0, np.int64), *(x[i].astype(np.int64) for x in held.values())]) for i in range(2))
            return pa.RecordBatch.from_arrays([names, pa.array(grams), pa.array(times)], ["language", "ngram", "n"])

        for batch in batches:
            for piece in pieces(batch, text_bytes(batch.column(1)), SLICE_BYTES):
                by_name: dict[str, list[str]] = {}
                for name, value in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    by_name.setdefault(name, []).append(value)
                for name, values in by_name.items():
                    own, n = np.unique(_ngrams(values)[0], return_counts=True)
                    if name in held:
                        before, times = held[name]
                        own, at = np.unique(np.concatenate([before, own]), return_inverse=True)
                        n = np.bincount(at, weights=np.concatenate([times, n]), minlength=len(own)).astype(np.int64)
                    held[name] = own, n
                if sum(len(x) for x, _ in held.values()) > _FLUSH:
                    yield flush()
                    held.clear()
        yield flush()

    counts = known.mapInArrow(count, "language string, ngram long, n long").groupBy("language", "ngram").agg(F.sum("n").alias("n"))
    # The most frequent of each of some parts of a language's n-grams, and of these the most frequent of the language.
    order = (F.desc("n"), "ngram")
    part = W.partitionBy("language", F.pmod(F.col("ngram"), F.lit(_SALTS))).orderBy(*order)
    best = counts.withColumn("nth", F.row_number().over(part)).where(F.col("nth") <= size)
    best = best.withColumn("nth", F.row_number().over(W.partitionBy("language").orderBy(*order))).where(F.col("nth") <= size)
    top = best.drop("nth").limit(max_languages * size + 1).collect()
    by_language: dict[str, list] = {}
    for row in top:
        by_language.setdefault(row.language, []).append((-row.n, row.ngram))
    if len(by_language) > max_languages or len(top) > max_languages * size:
        raise ValueError(f"{language} has more than {max_languages} values: it is no column of languages")
    languages = sorted(by_language)
    return Profiles(tuple(languages), tuple(tuple(ngram for _, ngram in sorted(by_language[x])) for x in languages))


class Classifier:
    """Finds the profile at the smallest out-of-place distance."""

    def __init__(self, profiles: Profiles):
        self.languages = profiles.languages
        self.size = max([1, *map(len, profiles.ngrams)])
        self.known = np.unique(np.array([x for ngrams in profiles.ngrams for x in ngrams], dtype=np.uint64))
        self.rank = np.full((len(self.languages), len(self.known) + 1), -1, dtype=np.int64)
        for i, ngrams in enumerate(profiles.ngrams):
            self.rank[i, np.searchsorted(self.known, np.array(ngrams, dtype=np.uint64))] = np.arange(len(ngrams))

    def distances(self, ranked: np.ndarray) -> np.ndarray:
        """For each language, from 0 (same ranks) to 1 (nothing in common)."""
        at = np.searchsorted(self.known, ranked)
        there = np.append(self.known, np.uint64(0))[at] == ranked
        rank = self.rank[:, np.where(there, at, len(self.known))]
        away = np.where(rank < 0, self.size, np.abs(rank - np.arange(len(ranked))[None, :]))
        return np.minimum(away, self.size).mean(axis=1) / self.size

    def classify(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Languages and scores. The score sets the best distance in proportion to the second best."""
        grams, owners = _ngrams(texts)
        bounds = np.searchsorted(owners, np.arange(len(texts) + 1))
        names, scores = [], []
        for a, b in zip(bounds[:-1], bounds[1:]):
            if a == b or not self.languages:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            distances = self.distances(_ranked(grams[a:b], self.size))
            best = int(np.argmin(distances))
            others = np.delete(distances, best)
            nearest = float(others.min()) if len(others) else 1.0
            names.append(self.languages[best])
            scores.append(min(1.0, max(0.0, 1.0 - distances[best] / nearest)) if nearest > 0 else 0.0)
        return names, scores


ADDED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def identify(df: DataFrame, profiles: Profiles, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``lang_pred`` and ``score`` (0 to 1, how clearly the language comes first) of every whole text.

    ``und`` with score 0 for null texts and those without a letter. Equal distances go to the
    language whose name sorts first. The columns ``keep`` (all by default) stay; those named
    like a result are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(profiles)

    def compute():
        classifier = Classifier(shared.value)

        def columns(texts: pa.Array) -> list[pa.Array]:
            names, scores = classifier.classify(texts.to_pylist())
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return columns

    return add_columns(df, text, ADDED, compute, keep, SLICE_BYTES)

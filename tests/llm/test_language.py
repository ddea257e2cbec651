import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retailweave.llm import language
from retailweave.llm.language import Classifier, Profiles, identify, learn
from retailweave.llm.queries import QUERIES

from conftest import rows
from llm.conftest import ODD_TEXTS, as_dict


def plain_ngrams(text):
    """Symbols of words between spaces, in ones, twos and threes."""
    symbols, words = language._symbols(), "".join(c if c.isalpha() else " " for c in text or "").split()
    chain = [1] + [x for word in words for x in [*(int(symbols[ord(c)]) for c in word), 1]] if words else []
    ones = [x for x in chain if x != 1]
    twos = [a << 21 | b for a, b in zip(chain, chain[1:])]
    threes = [a << 42 | b << 21 | c for a, b, c in zip(chain, chain[1:], chain[2:])]
    return ones + twos + threes


TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aBé ß.1\n日ñ", max_size=15)), max_size=7)


@given(TEXTS)
def test_ngrams(values):
    grams, owners = language._ngrams(values)
    for i, value in enumerate(values):
        assert sorted(grams[owners == i].tolist()) == sorted(plain_ngrams(value))


def distance(text, profile, size):
    counts = Counter(plain_ngrams(text))
    ranked = sorted(counts, key=lambda x: (-counts[x], x))[:size]
    place = {x: i for i, x in enumerate(profile)}
    return sum(min(size, abs(place[x] - i)) if x in place else size for i, x in enumerate(ranked)) / len(ranked) / size


@given(st.lists(st.text(alphabet="abcde ", min_size=1, max_size=60).filter(lambda x: x.strip()), min_size=1, max_size=5))
def test_distances_equal_the_definition(values):
    profiles = []
    for sample in ("abc bcd abd cab", "eed dee cde edc de"):
        counts = Counter(plain_ngrams(sample))
        profiles.append(tuple(sorted(counts, key=lambda x: (-counts[x], x))[:20]))
    classifier = Classifier(Profiles(("x", "y"), tuple(profiles)))
    names, scores = classifier.classify(values)
    for value, name, score in zip(values, names, scores):
        expected = [distance(value, profile, classifier.size) for profile in profiles]
        assert name == ("x" if expected[0] <= expected[1] else "y")
        assert score == pytest.approx(1 - min(expected) / max(expected))


SAMPLES = {
    "en": "the quick brown fox and the lazy dog went over there with another one",
    "de": "der schnelle braune fuchs und der faule hund gingen über die straße",
    "fr": "le renard brun et le chien paresseux sont allés à la maison où il était",
}


def training(spark):
    return spark.createDataFrame([(lang, text) for lang, text in SAMPLES.items() for _ in range(5)], "lang string, text string")


def test_profiles_are_the_most_frequent_ngrams_of_all_rows(spark):
    df = training(spark).repartition(7)
    profiles = learn(df, size=30)
    assert profiles.languages == ("de", "en", "fr")
    for name, ngrams in zip(profiles.languages, profiles.ngrams):
        counts = Counter(plain_ngrams(SAMPLES[name]))
        assert ngrams == tuple(sorted(counts, key=lambda x: (-counts[x], x))[:30])
    assert learn(df.coalesce(1), size=30) == profiles


def test_languages_and_odd_texts(spark, texts):
    profiles = learn(training(spark))
    values = ["THE DOG", "die Straße", "à la maison", *ODD_TEXTS]
    found = as_dict(identify(texts(values), profiles), "doc_id", "lang_pred", "score")
    assert [found[i][0] for i in range(3)] == ["en", "de", "fr"]
    for i, value in enumerate(values):
        assert (found[i] == ("und", 0.0)) == (not any(c.isalpha() for c in value or ""))
        assert 0 <= found[i][1] <= 1


def test_ties_go_to_the_first_name(spark, texts):
    df = spark.createDataFrame([("b", "same text"), ("a", "same text")], "lang string, text string")
    assert [row.lang_pred for row in identify(texts(["same", "text"]), learn(df)).collect()] == ["a", "a"]


def test_no_languages_no_rows_and_clashing_columns(spark, texts, clashing):
    none = learn(spark.createDataFrame([(None, "text"), ("en", None)], "lang string, text string"))
    assert none.languages == () and [row.lang_pred for row in identify(texts(["x"]), none).collect()] == ["und"]
    without_letters = learn(spark.createDataFrame([("en", "12"), ("de", "wort")], "lang string, text string"))
    assert [row.lang_pred for row in identify(texts(["x"]), without_letters).collect()] == ["de"]
    df = clashing(texts(["a"]), "LANG_PRED", "score", "ngram")
    assert identify(df, none).columns == ["doc_id", "text", "ngram", "lang_pred", "score"]
    assert identify(texts([]), none).collect() == []
    assert rows(identify(texts(["the"]), learn(training(spark)), keep=["doc_id"]).select("lang_pred")) == [("en",)]


def test_letters_of_all_scripts_have_symbols_of_their_own():
    symbols = language._symbols()
    ranges = [(0x41, 0x250), (0x370, 0x400), (0x400, 0x530), (0x5D0, 0x5EB), (0x620, 0x700), (0x900, 0xA00), (0x3041, 0x3100), (0x4E00, 0xA000), (0xAC00, 0xD7A4)]
    letters = {chr(code).lower()[0] for a, b in ranges for code in range(a, b) if chr(code).isalpha()}
    assert len(letters) > 30_000 and len({int(symbols[ord(x)]) for x in letters}) == len(letters)
    assert symbols.max() < 1 << 21 and min(int(symbols[ord(x)]) for x in letters) > language._SPACE


def test_languages_of_other_scripts(spark, texts):
    samples = SAMPLES | {
        "ru": "быстрая коричневая лиса прыгает через ленивую собаку", "el": "η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί",
        "ar": "الثعلب البني السريع يقفز فوق الكلب الكسول", "ja": "すばやい茶色の狐がのろまな犬を飛び越える", "zh": "敏捷的棕色狐狸跳过了懒狗", "uk": "швидка коричнева лисиця стрибає через ледачого пса",
    }
    rows = [(lang, text) for lang, text in samples.items() for _ in range(3)]
    profiles = learn(spark.createDataFrame(rows, "lang string, text string"))
    values = ["коричневая собака", "το σκυλί", "الكلب البني", "茶色の犬", "棕色狐狸", "лисиця і пес", "the dog"]
    found = as_dict(identify(texts(values), profiles), "doc_id", "lang_pred")
    assert [found[i] for i in range(len(values))] == ["ru", "el", "ar", "ja", "zh", "uk", "en"]


def test_a_column_that_is_no_language_is_an_error(spark):
    df = spark.createDataFrame([(f"l{i}", f"text {i}") for i in range(12)], "lang string, text string")
    assert len(learn(df, max_languages=12).languages) == 12
    with pytest.raises(ValueError, match="lang has more than 11"):
        learn(df, max_languages=11)


def test_held_out_rows_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    known = as_dict(spark.read.parquet(f"{sf}/documents.parquet").where(F.col("lang").isNotNull()), "doc_id", "lang")
    found = QUERIES["op4_language_id"](spark, sf).collect()
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2) for row in found)
    held_out = [row for row in found if row.held_out and row.doc_id in known]
    assert np.mean([row.lang_pred == known[row.doc_id] for row in held_out]) >= 0.98

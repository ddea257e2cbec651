import re

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from retailweave.llm.batches import groups, pieces
from retailweave.llm.words import Words, span_hashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aBzÉß 0.9_\n日🎉", max_size=25)), max_size=8)


@given(TEXTS)
def test_words_are_those_of_the_pattern(values):
    words = Words(pa.array(values, pa.string()))
    for i, value in enumerate(values):
        own = [words.word(k).decode() for k in range(words.first[i], words.first[i + 1])]
        assert own == plain_words(value)
        assert words.count[i] == len(own)


@given(TEXTS)
def test_hashes_are_equal_for_equal_words_only(values):
    words = Words(pa.array(values, pa.large_string()))
    by_word = {}
    for k, hashed in enumerate(words.hashes.tolist()):
        assert by_word.setdefault(words.word(k), hashed) == hashed
    assert len(set(by_word.values())) == len(by_word)


@given(TEXTS, st.integers(1, 5))
def test_shingles_are_the_sets_of_ngrams(values, n):
    words = Words(pa.array(values, pa.string()))
    hashes, first = words.shingles(n)
    by_ngram = {}
    for i, value in enumerate(values):
        own = plain_words(value)
        grams = [tuple(own[k : k + n]) for k in range(max(len(own) - n + 1, 0))] or ([tuple(own)] if own else [])
        found = hashes[first[i] : first[i + 1]].tolist()
        assert len(found) == len(grams)
        for gram, hashed in zip(grams, found):
            assert by_ngram.setdefault(gram, hashed) == hashed
    assert len(set(by_ngram.values())) == len(by_ngram)


def test_slices_of_arrays():
    whole = pa.array(["zero", "one two", None, "three", "four five"])
    words = Words(whole.slice(1, 3))
    assert words.count.tolist() == [2, 0, 1] and words.word(2) == b"three"


def test_spans_hash_by_content():
    data = np.frombuffer(b"abcabcab", np.uint8)
    a, b, c = span_hashes(data, np.array([0, 3, 1]), np.array([3, 6, 4]))
    assert a == b != c


@given(st.lists(st.integers(0, 50), max_size=20), st.integers(1, 60))
def test_pieces_keep_every_row(sizes, most):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes)), pa.int64())], ["i"])
    found = list(pieces(batch, np.array(sizes, dtype=np.int64), most))
    assert [i for piece in found for i in piece.column(0).to_pylist()] == list(range(len(sizes)))
    for piece in found:
        own = [sizes[i] for i in piece.column(0).to_pylist()]
        assert len(own) == 1 or sum(own) <= most


@given(st.lists(st.integers(0, 4), max_size=30), st.integers(1, 7))
def test_groups_of_a_sorted_stream(keys, size):
    keys = sorted(keys)
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + size], pa.int64())], ["k"]) for i in range(0, len(keys), size)]
    found = [table.column("k").to_pylist() for table in groups(iter(batches), "k")]
    assert [len(set(x)) for x in found] == [1] * len(set(keys)) and sum(found, []) == keys

import math
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retailweave.llm import sentence_pieces
from retailweave.llm.queries import PIECE_MODEL, QUERIES
from retailweave.llm.sentence_pieces import Lattice, Vocabulary, decode, encode, read_vocabulary, round_trip

from conftest import rows
from llm.conftest import ODD_TEXTS, as_dict

VOCABULARY = read_vocabulary(PIECE_MODEL)
LATTICE = Lattice(VOCABULARY)
SMALL = Vocabulary((b" a", b"a", b"b", b"ab", b" ab", b"ba", b"bab", b" "), tuple(range(8)), tuple(range(8)), tuple(range(100, 356)))


def cut(lattice, texts, keys=None):
    keys = np.arange(len(texts), dtype=np.uint64) if keys is None else np.asarray(keys, dtype=np.uint64)
    return lattice.encode(pa.array(texts, pa.string()), keys)


@settings(deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text(alphabet=" \n▁éa日🎉0the", max_size=40)), max_size=6))
def test_decoding_gives_back_every_text(texts):
    texts = [None if x is None else x.encode("utf-8", "ignore").decode() for x in texts]
    ids = cut(LATTICE, texts)
    assert LATTICE.decode(ids).to_pylist() == texts
    for own, text in zip(ids.to_pylist(), texts):
        assert (own is None) == (text is None) and (not own) == (not text)


def test_odd_texts():
    assert LATTICE.decode(cut(LATTICE, ODD_TEXTS)).to_pylist() == ODD_TEXTS
    assert LATTICE.decode(cut(LATTICE, [])).to_pylist() == []


@settings(deadline=None)
@given(st.text(alphabet="ab é", min_size=1, max_size=12), st.integers(0, 2**64 - 1))
def test_a_text_is_cut_alike_in_any_batch(text, key):
    alone = cut(LATTICE, [text], [key]).to_pylist()[0]
    among = cut(LATTICE, ["the other", text, "ab " * 30, None, text], [1, key, 2, 3, key]).to_pylist()
    assert among[1] == among[4] == alone


def segmentations(text, vocabulary, alpha):
    """All segmentations of ``text`` with their probabilities, by trying every piece at every place."""
    n = len(vocabulary.pieces)
    total = math.log(sum(1 / r for r in range(1, n + 2)))
    weight = {p: (i, -alpha * (math.log(r + 1) + total)) for p, i, r in zip(vocabulary.pieces, vocabulary.ids, vocabulary.ranks)}

    @lru_cache(None)
    def ways(rest):
        if not rest:
            return [((), 0.0)]
        found = []
        for size in range(1, len(rest) + 1):
            piece = rest[:size]
            if piece in weight:
                i, w = weight[piece]
            elif size == 1:
                i, w = vocabulary.byte_ids[piece[0]], -alpha * (math.log(n + 1) + total)
            else:
                continue
            found += [((i, *tail), w + x) for tail, x in ways(rest[size:])]
        return found

    all_ways = ways(text)
    norm = math.log(sum(math.exp(w) for _, w in all_ways))
    return {way: math.exp(w - norm) for way, w in all_ways}


@pytest.mark.parametrize("text", ["abab", "ab ab", "babab", "abcab"])
@pytest.mark.parametrize("alpha", [0.0, 0.5, 1.0])
def test_samples_follow_the_lattice(text, alpha):
    """Over 20,000 keys each segmentation comes as often as its pieces' weights say."""
    n = 20_000
    drawn = Counter(tuple(x) for x in cut(Lattice(SMALL, alpha), [text] * n).to_pylist())
    expected = segmentations((" " + text).encode(), SMALL, alpha)
    assert abs(sum(expected.values()) - 1) < 1e-9 and set(drawn) <= set(expected)
    for way, p in expected.items():
        assert abs(drawn[way] / n - p) <= 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_large_alpha_gives_the_best_segmentation():
    texts = ["the house is over there", "segmentation"]
    for text, ids in zip(texts, cut(Lattice(VOCABULARY, 200.0), texts).to_pylist()):
        n = len(VOCABULARY.pieces)
        rank = dict(zip(VOCABULARY.pieces, VOCABULARY.ranks))
        norm = math.log(sum(1 / r for r in range(1, n + 2)))
        data, best = (" " + text).encode(), [0.0]
        for end in range(1, len(data) + 1):
            best.append(min((best[a] + math.log(rank[data[a:end]] + 1) + norm for a in range(max(0, end - 30), end) if data[a:end] in rank), default=1e9))
        piece = {i: p for p, i in zip(VOCABULARY.pieces, VOCABULARY.ids)}
        assert sum(math.log(rank[piece[i]] + 1) + norm for i in ids) == pytest.approx(best[-1])


def test_no_piece_crosses_a_cut():
    """The lattice of the whole text is that of its chunks: pieces over a cut would be lost."""
    for piece in VOCABULARY.pieces[::7]:
        data = np.frombuffer(piece, np.uint8)
        assert LATTICE.neighbours[data[:-1], data[1:]].all()


def test_frames_null_keys_repeated_rows_clashing_columns_and_no_rows(spark, clashing):
    table = [(1, "some text here"), (1, "some text here"), (None, "some text here"), (2, None), (3, "")]
    df = clashing(spark.createDataFrame(table, "doc_id long, text string").repartition(3), "Piece_IDs", "decoded", "extra")
    encoded = encode(df, VOCABULARY)
    assert encoded.columns == ["doc_id", "text", "decoded", "extra", "piece_ids"]
    back = decode(encoded, VOCABULARY)
    assert back.columns == ["doc_id", "text", "extra", "piece_ids", "decoded"]
    assert all(row.decoded == row.text for row in back.collect())
    assert rows(round_trip(df, VOCABULARY, keep=["doc_id"])) == rows(back.select("doc_id", "piece_ids", "decoded"))
    assert len({tuple(row.piece_ids) for row in back.where("doc_id = 1").collect()}) == 1
    assert as_dict(back, "doc_id", "piece_ids")[2] is None and as_dict(back, "doc_id", "piece_ids")[3] == []
    assert decode(encode(df.limit(0), VOCABULARY), VOCABULARY).collect() == []


def test_samples_depend_on_key_and_seed_only(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("understanding segmentations of internationalisation").alias("text"))
    first = encode(df, VOCABULARY)
    assert rows(first) == rows(encode(df.repartition(7), VOCABULARY))
    assert first.select("piece_ids").distinct().count() > 20
    assert rows(first) != rows(encode(df, VOCABULARY, seed=1))


def test_a_model_without_byte_fallback_is_an_error(monkeypatch):
    class Model:
        def __init__(self, model_proto):
            pass

        def get_piece_size(self):
            return 1

        def is_byte(self, i):
            return False

        is_control = is_unknown = is_unused = is_byte

        def get_score(self, i):
            return 0.0

        def id_to_piece(self, i):
            return "a"

    monkeypatch.setattr(sentence_pieces.sentencepiece, "SentencePieceProcessor", Model)
    with pytest.raises(ValueError, match="byte fallback"):
        read_vocabulary(PIECE_MODEL)


def test_the_query_is_lossless(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op10_sentencepiece"](spark, sf)
    assert found.count() == spark.read.parquet(f"{sf}/documents.parquet").count() == found.where("lossless").count()
    assert found.where("n_pieces <> size(piece_ids)").count() == 0

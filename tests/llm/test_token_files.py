import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retailweave.llm import token_files
from retailweave.llm.queries import op12_token_files
from retailweave.llm.token_files import Encoder, TokenFile, placed, read_documents, write_token_files
from tests.llm.conftest import ODD_TEXTS

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH, 2)


def encoded(encoder, texts):
    ids, first = encoder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(first, first[1:])]


def test_ids_are_those_of_the_library(encoder, library):
    pieces = [" ", " ", "\n", "\t", "\r\n", "a", "B", "é", "ł", "×", "1", "23", ",", ".", "'", "'s", "'re", " ", "　", "\u0085"]
    pieces += ["日", "🎉", "́", "\x00", "\x1c", "᠎", "​", "﻿", "<|endoftext|>", "abcdefghijkl", "thing", " the", "_"]
    chance = random.Random(3)
    texts = ["".join(chance.choices(pieces, k=chance.randint(0, 25))) for _ in range(8000)] + ODD_TEXTS
    for _ in range(2):  # the second time from the remembered pieces
        assert encoded(encoder, texts) == [library(text) + [2] for text in texts]


def test_a_full_table_of_pieces_forgets_and_stays_right(library, monkeypatch):
    monkeypatch.setattr(token_files, "_SLOT_BITS", 4)
    small = Encoder(PATH, None)
    words = [f"word{i} Other{i * 7}, {i}" for i in range(300)]
    assert encoded(small, words) == encoded(small, words) == [library(text) for text in words]


def test_an_encoder_wants_a_byte_level_tokenizer():
    with pytest.raises(ValueError, match="byte-level"):
        Encoder(public_tokenizers.path("word_bpe_49k.json"), 2)


def expected(rows, library, end=(2,)):
    out, at = [], 0
    for doc, text in rows:
        ids = library(text) + list(end)
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def read(files):
    found = read_documents(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc"))
    return sorted((tuple(row) for row in found.collect()), key=lambda row: (row[1], row[0] is not None, row[0] or 0))


@pytest.mark.parametrize("end", [2, None])
def test_documents_come_back_in_order(texts, tmp_path, library, end):
    df = texts(ODD_TEXTS + [f"text number {i}" for i in range(200)])
    found = read(write_token_files(df, str(tmp_path / "t"), PATH, end_id=end))
    rows = sorted(tuple(row) for row in df.select("doc_id", "text").collect())
    want = expected(rows, library, () if end is None else (end,))
    assert found == sorted(want, key=lambda row: (row[1], row[0]))


def test_files_are_flat_and_mapped(texts, tmp_path, library):
    df = texts(["one two", None, "three"])
    row, *others = write_token_files(df.coalesce(1), str(tmp_path / "t"), PATH, end_id=2).collect()
    flat = [i for text in ("one two", None, "three") for i in library(text) + [2]]
    assert not others and (row.n_documents, row.n_tokens, row.width, row.first_token, row.first_document) == (3, len(flat), 2, 0, 0)
    assert np.memmap(f"{row.path}.bin", "<u2", "r").tolist() == flat
    file = TokenFile(row.path)
    assert file.local and file.offsets().tolist() == [0, 3, 4, 4 + len(library("three")) + 1]
    assert file.documents(1, 3)[0].tolist() == [1, 2] and file.tokens(0, 3).tolist() == flat[:3]


def test_equal_and_null_ids_many_files_and_clashing_columns(spark, tmp_path, library, clashing, monkeypatch):
    rows = [(None, "b"), (None, None), (7, "same words"), (7, "same words"), (7, "other"), (-3, "first"), (9, "")] * 3
    df = clashing(spark.createDataFrame(rows, "key int, body string"), "id", "text", "nth", "hash", "part").repartition(4)
    found = read(write_token_files(df, str(tmp_path / "t"), PATH, "key", "body", 5))
    ids = [row[0] for row in found]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0)) and len(found) == len(rows)
    total = 0
    for doc, start, n, _ in found:
        assert start == total
        total += n
    texts_of = sorted((row[0] is not None, row[0] or 0, row[2], row[3]) for row in found)
    want = [(doc is not None, doc or 0, n, crc) for (doc, text) in rows for _, _, n, crc in expected([(doc, text)], library, (5,))]
    assert texts_of == sorted(want)


def test_bases_are_sums_over_files_and_partitions(spark):
    files = [(0, 0, "a", 2, 3, 30), (2, 1, "c", 2, 1, 5), (2, 0, "b", 2, 2, 20), (5, 0, "d", 2, 4, 40)]
    found = placed(spark.createDataFrame(files, "part int, nth int, path string, width int, n_documents long, n_tokens long"))
    assert {row.path: (row.first_document, row.first_token) for row in found.collect()} == {
        "a": (0, 0), "b": (3, 30), "c": (5, 50), "d": (6, 55)
    }


def test_no_documents(spark, tmp_path):
    files = write_token_files(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "t"), PATH, end_id=2)
    assert files.collect() == [] and read_documents(files).collect() == []


def test_query_equals_the_library(spark, library):
    sf_dir = "/root/testdata/sf0.01"
    rows = sorted(tuple(row) for row in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    assert sorted(tuple(row) for row in op12_token_files(spark, sf_dir).collect()) == expected(rows, library)

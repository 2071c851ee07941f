from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyframe.llm import piece_tokens
from tallyframe.llm.token_ids import public_tokenizer

MODEL = public_tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def words():
    return piece_tokens.vocabulary(MODEL)


def own(words, texts):
    ids, at = words.encode(texts)
    assert (ids[at[1:] - 1] == words.end).all()
    return [ids[low : high - 1].tolist() for low, high in zip(at, at[1:])]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" ▁\n\t\r.,aeinorst<s>0x"), st.characters(codec="utf-8")), max_size=60), max_size=5))
def test_ids_are_those_of_the_library(texts):
    words = piece_tokens.vocabulary(MODEL)
    assert own(words, texts) == words.library.encode(texts)


def test_runs_of_blanks_and_marks(words):
    texts = [" " * k + "a" + " " * (40 - k) for k in range(40)] + ["a" * 500, "\x00", "▁ ▁", "</s><s>", "﻿ a", "é́" * 30, "\n" * 50, "한글 漢字。漢字"]
    assert own(words, texts) == words.library.encode(texts)


def test_equal_scores_merge_from_the_left(words):
    assert own(words, [" " * k for k in range(1, 70)]) == words.library.encode([" " * k for k in range(1, 70)])


def test_long_parts_and_short_ones_agree(words, monkeypatch):
    texts = ["interesting " * 20 + "x" * 200 + ". " + "ab" * 40, "", "a" * 48 + " " + "a" * 49, "é" * 60]
    expected = words.library.encode(texts)
    for long in (48, 1, 1000):
        monkeypatch.setattr(piece_tokens, "LONG", long)
        words._forget()
        assert own(words, texts) == expected


def test_what_is_remembered_makes_no_difference(words, monkeypatch):
    texts = ["Every part is remembered. Until there are too many.", "part of it", "", "many. parts", "é 漢字 \x00"]
    expected = words.library.encode(texts)
    monkeypatch.setattr(piece_tokens, "KEPT_PARTS", 4)
    assert [own(words, [t])[0] for t in texts * 2] == expected * 2
    monkeypatch.setattr(piece_tokens, "KEPT_PARTS", 1000)
    assert [own(words, [t])[0] for t in texts * 2] == expected * 2


def test_a_very_long_word(words):
    text = "ab" * 300_000
    assert own(words, [text])[0] == words.library.encode(text)


def test_what_is_merged_otherwise_is_refused(words):
    # A vocabulary of its own, with nothing remembered.
    other = piece_tokens.PieceVocabulary(MODEL)
    other.merge_rank = other.merge_rank.max() - other.merge_rank
    with pytest.raises(ValueError, match="merges otherwise"):
        other.encode(["interesting things are said there"])


def test_every_row_agrees_with_the_library(spark, odd_docs, odd_rows, words):
    rows = piece_tokens.decode_ids(piece_tokens.encode_texts(odd_docs, MODEL), MODEL)
    found = sorted(((r.doc_id, tuple(r.ids), r.decoded) for r in rows.collect()), key=str)
    expected = []
    for doc_id, text, *_ in odd_rows:
        ids = words.library.encode(text or "", add_eos=True)
        expected.append((doc_id, tuple(ids), words.library.decode(ids)))
    assert found == sorted(expected, key=str)
    assert next(r for r in expected if r[0] == 1)[1] == (words.end,)


def test_empty_table_and_empty_ids(spark, no_docs):
    assert piece_tokens.decode_ids(piece_tokens.encode_texts(no_docs, MODEL), MODEL).count() == 0
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id int, ids array<int>")
    assert [r.decoded for r in piece_tokens.decode_ids(rows, MODEL).collect()] == ["", ""]


def test_query_digests(spark, words):
    folder = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in piece_tokens.op13_piece_tokens(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", F.coalesce("text", F.lit(""))).collect()
    assert len(found) == len(rows)
    for doc_id, text in rows:
        ids = words.library.encode(text, add_eos=True)
        row = found[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == sha(" ".join(map(str, ids)))
        assert row.decoded_sha256 == sha(words.library.decode(ids))

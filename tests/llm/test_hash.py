"""Hashes of words and lines that must tell any two texts apart."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from tallyframe.llm import jaccard_join, quality_rules, vec
from llm.brute import base_counts, jaccard_components


def parity_pair(size: int) -> tuple[str, str]:
    """Two strings that are equal to every sum of letter times power modulo 2**64."""
    one = "".join("ab"[bin(k).count("1") % 2] for k in range(size))
    return one, one.translate(str.maketrans("ab", "ba"))


def hashes(words: list[bytes]) -> list[int]:
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([0, *map(len, words)])
    return vec.span_hashes(data, ends[:-1], ends[1:]).tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=30))
def test_equal_spans_only(words):
    found = hashes(words)
    assert len(set(found)) == len(set(words)) and all((a == b) == (x == y) for a, x in zip(found, words) for b, y in zip(found, words))


def test_blocks_make_no_difference(monkeypatch):
    words = [bytes([k % 7]) * (k % 23) for k in range(500)]
    whole = hashes(words)
    monkeypatch.setattr(vec, "SPANS_AT_ONCE", 7)
    assert hashes(words) == whole


def test_strings_of_parities(spark):
    for size in (32, 64, 128, 1024, 4096):
        one, two = parity_pair(size)
        assert len(set(hashes([one.encode(), two.encode()]))) == 2
    one, two = parity_pair(1024)
    docs = [(1, one), (2, two), (3, one), (4, f"{one}\n{two}\n{one}"), (5, " ".join([one, two] * 60))]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = jaccard_join.link_components(table).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(jaccard_components(docs, 4, 85))
    data, offsets = vec.string_bytes(pa.array([text for _, text in docs]))
    counted = dict(zip(quality_rules.COUNTS, quality_rules.counts(data, offsets)))
    assert counted["n_dup_lines"].tolist() == [base_counts(text)[3] for _, text in docs] == [0, 0, 0, 1, 0]
    assert counted["n_repeat_words"].tolist() == [base_counts(text)[4] for _, text in docs]

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyframe.llm import lexical_search as search
from llm.brute import LOW

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string"


def plain(docs, items, top=10):
    """(item_id, rank, doc_id, score) of rows (doc_id, text) for rows (item_id, text)."""
    terms = [(i, Counter(TERM.findall((text or "").translate(LOW)))) for i, text in docs]
    terms = [(i, found) for i, found in terms if found]
    n, total = len(terms), sum(sum(found.values()) for _, found in terms)
    df = Counter(term for _, found in terms for term in found)
    asked: dict = {}
    for i, text in items:
        asked.setdefault(i, set()).update(TERM.findall((text or "").translate(LOW)))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, found in terms:
            m = 100 - 90 + (90 * sum(found.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * found[t]) // (1000 * found[t] + 8 * m))
                for t in wanted if t in found
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def table(spark, docs, parts=3):
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return frame.repartition(parts)


def found(spark, docs, items, **options):
    index, n = search.write_index(table(spark, docs))
    return rows_of(search.search(index, n, spark.createDataFrame(items, ITEMS), **options))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    words = [f"w{int(rng.paretovariate(0.6)) % 900}" for _ in range(60_000)]
    docs = [(i, " ".join(words[rng.randrange(50_000):][: rng.randrange(1, 120)])) for i in range(700)]
    docs += [(2000 + i, "Same text, again and again") for i in range(60)]
    docs += [(9000, None), (9001, ""), (9002, " .,;"), (9003, "é É ü ÄÖ w1"), (None, "w1 w2 w3"), (5, "w1 w1 w1"), (5, "w1 w1 w1"), (-3, "W1-w2_w3\x7fw4")]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for k in range(40)]
    items += [(100, "again SAME text"), (101, None), (102, "..."), (103, "unheard"), (104, "É ä"), (None, "w1"), (7, "w5 again"), (7, None), (105, "w1")]
    return docs, items


@pytest.mark.parametrize("docs_a_block", [8192, 64, 1])
def test_ranks_against_brute_force(spark, corpus, monkeypatch, docs_a_block):
    docs, items = corpus
    docs = docs if docs_a_block > 1 else docs[::20]
    monkeypatch.setattr(search, "BLOCK_DOCS", docs_a_block)
    assert found(spark, docs, items) == plain(docs, items)


def test_items_in_parts_and_other_depths(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(search, "ASKED_TERMS", 200)
    for top in (1, 3, 200):
        assert found(spark, docs, items, top=top) == plain(docs, items, top)


def test_odd_rows_and_clashing_names(spark, odd_docs, odd_rows):
    items = [(1, "one two three"), (2, "word"), (3, "x" * 400), (4, odd_rows[0][1]), (5, odd_rows[6][1])]
    index, n = search.write_index(odd_docs.withColumns({"rank": F.lit(1), "terms": F.lit("t"), "df": F.lit(0)}))
    asked = spark.createDataFrame(items, ITEMS).withColumns({"doc_id": F.lit(1), "rank": F.lit("r"), "terms": F.lit(2)})
    assert rows_of(search.search(index, n, asked)) == plain([r[:2] for r in odd_rows], items)


def test_empty_tables(spark, no_docs):
    index, n = search.write_index(no_docs)
    assert n == 0 and found(spark, [(1, "a"), (2, None)], []) == []
    assert rows_of(search.search(index, n, spark.createDataFrame([(1, "a")], ITEMS))) == []
    assert found(spark, [(1, None), (2, ".")], [(1, "a")]) == []


def test_a_very_long_text(spark):
    docs = [(1, " ".join(f"t{i % 5000}" for i in range(400_000))), (2, "t1 t2"), (3, "x" * 3_000_000), (4, "t1")]
    items = [(1, "t1 t2 t4999"), (2, "x" * 3_000_000)]
    assert found(spark, docs, items) == plain(docs, items)


def test_a_term_in_every_document_has_no_weight(spark):
    docs = [(i, "all " + "odd " * (i % 2)) for i in range(3000)]
    assert found(spark, docs, [(1, "all odd"), (2, "all")]) == plain(docs, [(1, "all odd"), (2, "all")])


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70), st.integers(1, 70), st.data())
def test_treap_steps_reach_every_entry(rows, columns, data):
    places = data.draw(st.sets(st.integers(0, rows * columns - 1), min_size=1, max_size=200))
    place = np.array(sorted(places))
    values = np.array(data.draw(st.lists(st.integers(1, 10**6), min_size=len(place), max_size=len(place))))
    height = max(1, int(max(rows, columns) - 1).bit_length())
    packed = search._unpack(search._pack(search.grid_levels(place // columns, place % columns, values, height)))
    tree = search.Treap(packed, height)
    assert tree.most[0] == values.max()
    for row in range(rows):
        for column in range(columns):
            node = np.zeros(1, np.int64)
            for down in range(height):
                shift = height - 1 - down
                node = tree.step(node, np.array([2 * ((row >> shift) & 1) + ((column >> shift) & 1)]))
            at = np.flatnonzero(place == row * columns + column)
            assert tree.most[node[0]] == (values[at[0]] if len(at) else 0)


def test_only_few_ranges_are_opened(corpus):
    """Best-first: the planted document is found without opening most columns."""
    rng = np.random.default_rng(2)
    size = 4096
    rows = np.repeat(np.arange(30), 200)
    columns = np.concatenate([rng.choice(size, 200, replace=False) for _ in range(30)])
    rows, columns = np.append(rows, np.arange(30)), np.append(columns, np.full(30, 77))
    place = np.unique(rows * size + columns)
    tree = search.Treap(search.grid_levels(place // size, place % size, np.full(len(place), 9), 12), 12)
    opened = 0
    step = tree.step

    def counted(nodes, quarter):
        nonlocal opened
        opened += nodes.shape[0] if nodes.ndim > 1 else 0
        return step(nodes, quarter)

    tree.step = counted
    best = tree.best(np.arange(30), np.ones(30, np.int64), np.arange(size), [], 1)
    assert best == [(270, 77)] and opened < size

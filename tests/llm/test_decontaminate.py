from __future__ import annotations

import random

import pytest

from llm.brute import contained_items
from llm.conftest import SCHEMA, prose
from tallyframe.llm import decontaminate as D


def found(docs, items):
    return {(r.doc_id, r.item_id, r.shared, r.item_shingles) for r in D.contained(docs, items).collect()}


@pytest.fixture(scope="module")
def cases(spark):
    """Items of 4 to 300 words in long documents, whole, with changes, cut and mixed."""
    rng = random.Random(3)
    items = [(k, prose(rng, n)) for k, n in enumerate((4, 5, 6, 15, 33, 60, 150, 300, 40, 40))] + [(20, None), (21, ""), (3, prose(rng, 15))]
    rows = []
    for i in range(120):
        words = prose(rng, rng.randint(0, 600)).split()
        for _, text in rng.sample(items, 2):
            own = (text or "").split()
            for _ in range(rng.randint(0, 1 + len(own) // 12) if own else 0):
                own[rng.randrange(len(own))] = "changed"
            own = own[: rng.randint(len(own) * 3 // 4, len(own))] if rng.random() < 0.4 else own
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() for w in own] if rng.random() < 0.3 else own
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA).repartition(4)
    return docs, spark.createDataFrame(items, "item_id bigint, text string"), rows, items


def test_all_contained_items_are_found(cases):
    docs, items, rows, own = cases
    single = [(k, t) for k, t in own if k != 3]
    want = contained_items(rows, single)
    assert {x for x in found(docs, items) if x[1] != 3} == want and len(want) > 40


def test_a_large_sample_is_joined_by_shuffle(cases, monkeypatch):
    docs, items, rows, own = cases
    sent = found(docs, items)
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    assert found(docs, items) == sent


def test_odd_and_empty_tables(spark, odd_docs, no_docs, odd_rows):
    items = spark.createDataFrame([(1, odd_rows[0][1]), (1, odd_rows[0][1]), (None, odd_rows[6][1]), (2, None)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in D.contained(odd_docs, items).collect()}
    assert {(9, 1), (4, 1), (7, 1), (None, 1), (5, None), (6, None)} == got
    left = D.without_items(odd_docs, items)
    assert left.columns == odd_docs.columns and left.count() == len(odd_rows) - 7
    assert D.contained(no_docs, items).count() == 0
    assert D.contained(odd_docs, items.limit(0)).count() == 0
    assert D.without_items(odd_docs, items.limit(0)).count() == len(odd_rows)


def test_no_python_in_the_plan(cases):
    docs, items, *_ = cases
    plan = D.contained(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_texts_of_one_item_have_no_shingle_across(spark):
    """Items of one id (or none) and several short texts, whole and in part, in documents."""
    texts = {k: ["a1 b c d e", f"f{k} g h i j", "k1 l m n o p"] for k in (1, 2, None)}
    items = [(k, t) for k, own in texts.items() for t in (own[:2] if k == 1 else own)] + [(1, "a1 b c d e"), (3, "a1 b c d e f1 g h i j"), (2, None)]
    rows = [(0, "x " + " y ".join(texts[1])), (1, " z ".join(reversed(texts[2]))), (2, " z ".join(texts[None])), (3, texts[1][0]), (4, "a1 b c d e f1 g h i j")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA).repartition(2)
    cut = lambda text: {tuple(w[i : i + 5]) for w in [(text or "").split()] for i in range(len(w) - 4)}
    want = set()
    for k in {k for k, _ in items}:
        whole = set().union(*(cut(t) for i, t in items if i == k))
        want |= {(d, k, len(cut(t) & whole), len(whole)) for d, t in rows if whole and 100 * len(cut(t) & whole) >= 80 * len(whole)}
    assert {(0, 1), (4, 3), (1, 2), (2, None)} <= {x[:2] for x in want}
    assert found(docs, spark.createDataFrame(items, "item_id bigint, text string")) == want

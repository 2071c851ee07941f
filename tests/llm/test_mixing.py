from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from tallyframe.llm import mixing as X


def shared_out(sizes: list[int], most: int = 3) -> list[float]:
    """Targets by sharing again and again what is over a source's limit."""
    weights = [X.WEIGHTS[k % 3] for k in range(len(sizes))]
    capped: set[int] = set()
    while True:
        left = sum(sizes) - sum(most * sizes[k] for k in capped)
        total = sum(w for k, w in enumerate(weights) if k not in capped)
        share = [most * s if k in capped else left * weights[k] / total for k, s in enumerate(sizes)]
        over = {k for k, s in enumerate(sizes) if k not in capped and share[k] >= most * s}
        if not over:
            return share
        capped |= over
        if len(capped) == len(sizes):
            return [float(most * s) for s in sizes]


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 5, 100, 10_000]) for _ in range(rng.randint(1, 12))]
    names = [f"s{k:02d}" for k in range(len(sizes) - 1)] + [None]
    frame = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size bigint")
    got = {r.source: r.target for r in X.targets(frame).collect()}
    assert [got[n] for n in names] == pytest.approx(shared_out(sizes) if sum(sizes) else [0.0] * len(sizes))


def test_mix(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["a", "a", "a", "b", "é", "Z", None]), 1.0) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, target double").repartition(5)
    got = X.mix(docs).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in got)
    totals, taken = Counter(), Counter()
    for r in got:
        totals[r.source] += r.size
        taken[r.source] += r.taken
    for r in got:
        assert r.source_size == totals[r.source] and abs(taken[r.source] - r.target) <= 60
    order = sorted((s for s in totals if s is not None), key=lambda s: s.encode()) + [None]
    assert {r.source: r.target for r in got} == pytest.approx(dict(zip(order, shared_out([totals[s] for s in order]))))
    again = X.mix(docs.repartition(2)).collect()
    assert {(r.doc_id, r.taken) for r in got} == {(r.doc_id, r.taken) for r in again}
    repeated = X.mixed_rows(docs)
    assert repeated.columns == docs.columns
    assert Counter(r.doc_id for r in repeated.collect()) == Counter({r.doc_id: r.copies for r in got if r.copies})


def test_equal_rows_are_taken_in_part(spark):
    """A source of one repeated row, one of two, one of rows that differ in another column only, and one of all kinds."""
    rows = [(1, "w " * 10, "a", k % 3) for k in range(400)] + [(2, "w " * 7, "b", 0)] * 120 + [(3, "w " * 3, "b", 0)] * 200
    rows += [(k, "w " * (k % 9), "c", 0) for k in range(10, 400)] + [(4, "", None, 0)] * 50 + [(5, "w", "d", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, mark int").repartition(7)
    got = X.mix(docs).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert len(got) == len(rows) and all(r.taken <= 3 * r.size for r in got)
    for source, most in (("a", 10), ("b", 7), ("c", 8), ("d", 1), (None, 0)):
        assert abs(taken[source] - target[source]) <= most / 2 + 1e-9, source
    again = X.mix(docs.repartition(3)).collect()
    kinds = lambda rows: Counter((r.doc_id, r.text, r.mark, r.taken) for r in rows)
    assert kinds(got) == kinds(again)
    assert len(X.mixed_rows(docs).collect()) == sum(r.copies for r in got)


def test_odd_rows(odd_docs, odd_rows):
    got = X.mix(odd_docs).collect()
    words = lambda t: len(re.findall(X.WORD, t or ""))
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, words(t)) for i, t, *_ in odd_rows)
    assert all(r.n == 1 and r.bucket == 0 and r.taken <= 3 * r.size for r in got)
    assert X.mixed_rows(odd_docs).columns == odd_docs.columns


def test_empty_table(no_docs):
    assert X.mix(no_docs).count() == 0 and X.mixed_rows(no_docs).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=9))
def test_shared_targets_add_up(sizes):
    assert sum(shared_out(sizes)) == pytest.approx(sum(sizes)) if sum(sizes) else True

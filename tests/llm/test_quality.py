from __future__ import annotations

import math
import random
import time

import numpy as np
import pyarrow as pa
import pytest

from llm.brute import base_counts
from llm.conftest import prose
from tallyframe.llm import quality_model as M, quality_rules as Q, toxicity as T, vec


@pytest.fixture(scope="module")
def labelled(spark):
    """Clean, junk and insulting texts with labels; every fifth has none."""
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(700):
        words = prose(rng, rng.randint(60, 160)).split()
        quality, toxic = int(rng.random() > 0.3), int(rng.random() < 0.3)
        if not quality:
            words = [w + rng.choice(["%%%", "$$$"]) for w in words]
        if toxic:
            for _ in range(5):
                words[rng.randrange(len(words))] = rng.choice(["stinkface", "numbskull", "dunderhead"])
        rows.append((i, " ".join(words), "en", "s", 0))
        if i % 5:
            labels.append((i, quality, toxic))
    labels += [(3, 0, 0), (3, 1, 1), (None, 1, 1), (9999, 1, 0), (4, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), {i: t for i, t, *_ in rows}


def held_accuracy(scored, labels, column):
    truth = {r.doc_id: r[column] for r in labels.collect() if r[column] is not None and r.doc_id not in (3, 9999)}
    rows = [r for r in scored.collect() if r.held_out and r.doc_id in truth]
    assert len(rows) > 50 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    return sum(r.predicted == truth[r.doc_id] for r in rows) / len(rows)


def test_quality_model(labelled):
    docs, labels, _ = labelled
    assert held_accuracy(M.classify(docs, labels), labels, "quality") > 0.95


def test_toxicity(labelled):
    docs, labels, _ = labelled
    assert held_accuracy(T.classify(docs, labels), labels, "toxic") > 0.95
    left = T.without_toxic(docs, labels)
    toxic = {r.doc_id for r in labels.filter("toxic = 1").collect()}
    gone = {r.doc_id for r in docs.select("doc_id").subtract(left.select("doc_id")).collect()}
    assert left.columns == docs.columns and len(gone & toxic) > 0.9 * len(toxic & set(range(700))) and len(gone - toxic) < 60


@pytest.mark.parametrize("module", [M, T])
def test_models_on_odd_tables(module, odd_docs, no_docs, labelled, odd_rows):
    labels = labelled[1]
    rows = module.classify(odd_docs, labels).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert module.classify(no_docs, labels).count() == 0
    assert all(0 <= r.score <= 1 for r in module.classify(odd_docs, labels.limit(0)).collect())


def test_folds_follow_crc32(labelled):
    import zlib

    docs, labels, _ = labelled
    for r in M.classify(docs, labels).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_scores_are_dot_products(labelled):
    """A batch gives each text what it gets alone."""
    texts = list(labelled[2].values())[:30] + ["", "one", "a a a a"]
    weights = np.random.default_rng(1).normal(size=(1 << M.TABLE_BITS) + 1)
    data, offsets = vec.string_bytes(pa.array(texts))
    at, place, value = M.features(data, offsets)
    for i, text in enumerate(texts):
        own = M.features(*vec.string_bytes(pa.array([text])))
        here = slice(at[i], at[i + 1])
        assert dict(zip(place[here], value[here])) == pytest.approx(dict(zip(own[1], own[2])))
        assert math.isclose(weights[place[here]] @ value[here], weights[own[1]] @ own[2], abs_tol=1e-9)


def test_base_counts(odd_docs, odd_rows, labelled):
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in Q.apply_rules(odd_docs, labelled[1]).collect()), key=str)
    assert got == sorted(((i, *base_counts(t)) for i, t, *_ in odd_rows), key=str)


def test_rules_reject_junk_and_keep_the_clean(labelled):
    docs, labels, texts = labelled
    rows = Q.apply_rules(docs, labels).collect()
    junk = {i for i, t in texts.items() if "%%%" in t or "$$$" in t}
    assert all(r.kept != (r.doc_id in junk) for r in rows)
    # No label, no cutoff: the base rules alone decide.
    assert all(r.kept != r.base_failed for r in Q.apply_rules(docs, labels.limit(0)).collect())


def test_empty_table_of_rules(no_docs, labelled):
    assert Q.apply_rules(no_docs, labelled[1]).count() == 0


@pytest.mark.parametrize("k,n,error", [(0, 100, 0.05), (3, 100, 0.01), (10, 10, 0.05), (7, 2000, 0.001)])
def test_upper_bound_is_exact(k, n, error):
    p = Q.upper_bound(k, n, error)
    tail = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert p == 1.0 if k == n else math.isclose(tail, error, rel_tol=1e-6)


@pytest.mark.parametrize("k, n, p", [(0, 5, 0.3), (20_000, 400_000, 0.0503), (3, 10, 0.9), (500, 1000, 0.5), (99, 100, 0.99), (1_000_000, 30_000_000, 0.0334)])
def test_tails_by_continued_fraction(k, n, p):
    if n <= 400_000:
        logs = np.array([math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)])
        assert Q.beta_share(n - k, k + 1, 1 - p) == pytest.approx(float(np.exp(logs).sum()), rel=1e-7)
    else:
        assert 0 < Q.beta_share(n - k, k + 1, 1 - p) < 1


def test_bounds_of_millions_take_no_time():
    started = time.perf_counter()
    bounds = [Q.upper_bound(40_000 * k, 1_000_000 * k, 1e-6) for k in (1, 10, 100)]
    assert time.perf_counter() - started < 2 and 0.04 < bounds[2] < bounds[1] < bounds[0] < 0.042


def test_a_ladder_pays_for_every_start_it_can_have():
    """The same documents, seen by the first rule and by the last one: the last asks for more of them."""
    taken = {}
    for rule in (0, len(Q.RULES) - 1):
        for total in range(60, 1200, 20):
            steps = np.full((2, len(Q.RULES)), 6)
            steps[0, rule] = 0
            if Q.choose(steps, np.array([0, total]), 0.05)[rule] >= 0:
                taken[rule] = total
                break
    assert taken[0] == 60 and taken[len(Q.RULES) - 1] == pytest.approx(-math.log(0.05 / 7**5) / -math.log(0.95), abs=20)


def test_limit_holds_under_resampling():
    """Over many samples with a true rejection share above the limit at every step, a step is taken rarely."""
    rng, taken = np.random.default_rng(2), 0
    for _ in range(400):
        steps = np.full((2, len(Q.RULES)), 6)
        steps[1, 0] = 0
        bad = rng.binomial(600, 0.055)
        taken += Q.choose(steps, np.array([600 - bad, bad]), 0.05)[0] >= 0
    assert taken <= 0.05 * 400 + 3 * math.sqrt(400 * 0.05)

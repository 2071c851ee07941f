from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tallyframe.llm import jaccard_join as J
from tallyframe.llm.components import components
from llm.brute import jaccard_components
from llm.conftest import SCHEMA, prose


def found(docs, size=4, percent=85):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in J.link_components(docs, size, percent).collect())


def test_odd_rows(odd_docs, odd_rows):
    assert found(odd_docs) == Counter(jaccard_components([r[:2] for r in odd_rows], 4, 85))


def test_empty_table(no_docs):
    assert J.link_components(no_docs).count() == 0
    assert J.one_of_each(no_docs).count() == 0


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_chains_and_common_passages(spark, size, percent, monkeypatch):
    """Near copies in chains, and a passage that most texts share, so that tokens are frequent."""
    monkeypatch.setattr(J, "LEAST_COUNT", 5)
    monkeypatch.setattr(J, "NEXT_CLASS", 4)
    rng = random.Random(percent)
    passage, rows = prose(rng, 60), []
    for group in range(12):
        words = prose(rng, rng.randint(6, 120)).split()
        for _ in range(rng.randint(1, 9)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(1000)}"
            rows.append((len(rows), (passage + " " if group % 2 else "") + " ".join(words)))
    for k in range(40):
        rows.append((len(rows), passage + " " + " ".join(f"own{k}-{i}" for i in range(rng.randint(0, 14)))))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA).repartition(4)
    assert found(docs, size, percent) == Counter(jaccard_components(rows, size, percent))


def test_one_of_each_keeps_the_least(odd_docs, odd_rows):
    kept = J.one_of_each(odd_docs, 5, 80)
    assert kept.columns == odd_docs.columns
    rows = [r[:2] for r in odd_rows]
    want = jaccard_components(rows, 5, 80)
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[9] == 0 and ids[7] == 0 and ids[4] == 2  # two texts of id 4, the copies gone
    assert ids[1] == ids[2] == ids[3] == 1 and ids[None] == 1  # texts without words all stay
    groups = {c for i, n, c in want if n}
    assert sum(ids.values()) == len(groups) + 1 + sum(n == 0 for _, n, _ in want)


tokens = st.sets(st.integers(0, 60), min_size=7, max_size=40)


@settings(max_examples=300, deadline=None)
@given(tokens, st.sets(st.integers(0, 60), max_size=3), st.sets(st.integers(0, 60), max_size=3), st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60)))
def test_similar_sets_share_a_signature(base, more, less, second, third):
    """Whatever tokens are frequent: sets that are similar enough have a signature in common."""
    other = (base | more) - less
    if len(other) < 7 or 100 * len(base & other) < 85 * len(base | other):
        return
    klass = {t: 3 if t in third else 2 if t in second else 1 for t in range(61)}

    def signatures(tokens):
        own, need = sorted(tokens), J.missing(len(tokens), 85) + 1
        rare = [t for t in own if klass[t] == 1][:need]
        out = {("rare", t) for t in rare}
        if len(rare) < need:
            ordered = [(k, t << 20) for k in (2, 3) for t in own if klass[t] == k]
            scale, last = len(own).bit_length() - 1, (len(own) * 100 // 85).bit_length() - 1
            for s in range(scale, last + 1):
                out |= {("many", v) for v in J.frequent_signatures(ordered, need - len(rare), s)}
        return out

    assert signatures(base) & signatures(other)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40) if i % 13] + [(100, i) for i in range(101, 150)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    edges = [e for e in edges if e[0] != e[1]]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: find(n) for n in root}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_sets_are_distinct_and_ordered():
    from tallyframe.llm import vec
    import pyarrow as pa

    texts = ["a b a b a b a b", "", None, "A B", "x y z w v"]
    data, offsets = vec.string_bytes(pa.array(texts))
    made, at = J.sets_of(data, offsets, 4)
    assert np.diff(at).tolist() == [2, 0, 0, 1, 2]
    for low, high in zip(at[:-1], at[1:]):
        assert (np.diff(made[low:high].astype(object)) > 0).all()


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_short_texts_link_with_one_word_more(spark, size, percent, monkeypatch):
    """Sets of 1 to 8 shingles and the same with a word before or after, rare and frequent."""
    monkeypatch.setattr(J, "LEAST_COUNT", 5)
    monkeypatch.setattr(J, "NEXT_CLASS", 4)
    rows = []
    for n in range(1, 9):
        for group in range(3):
            words = [f"w{n}-{group}-{i}" for i in range(n + size - 1)]
            for text in (words, ["before", *words], [*words, "after"], ["other", *words[1:]]):
                rows.append((len(rows), " ".join(text)))
            # Many supersets make the shingles frequent.
            rows += [(len(rows) + k, " ".join([*words, f"end{k}"])) for k in range(20 if group == 2 else 0)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA).repartition(3)
    want = jaccard_components(rows, size, percent)
    sizes = {i: n for i, n, _ in want}
    assert any((sizes[c], n) == {85: (6, 7), 80: (4, 5)}[percent] for _, n, c in want)
    assert found(docs, size, percent) == Counter(want)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 9), st.integers(0, 9), st.sampled_from([85, 80]), st.sets(st.integers(0, 20)), st.sets(st.integers(0, 20)))
def test_small_sets_have_signatures_where_they_can_link(n, more, percent, second, third):
    """A set links with a superset only if it is indexed, and then both take enough signatures."""
    base, other = list(range(n)), list(range(n + more))
    if 100 * n < percent * (n + more) or not more:
        return
    klass = {t: 3 if t in third else 2 if t in second else 1 for t in range(21)}

    def signatures(own):
        need = J.missing(len(own), percent) + 1
        rare = [t for t in own if klass[t] == 1][:need]
        out = {("rare", t) for t in rare}
        if len(rare) < need:
            ordered = [(k, t << 20) for k in (2, 3) for t in own if klass[t] == k]
            for s in range(len(own).bit_length() - 1, (len(own) * 100 // percent).bit_length()):
                out |= {("many", v) for v in J.frequent_signatures(ordered, need - len(rare), s)}
        return out

    assert J.links_apart(n, percent) and J.links_apart(n + more, percent)
    assert signatures(base) & signatures(other)


def test_components_from_several_tasks(spark, monkeypatch):
    """Long paths, stars and repeated edges, contracted in several tasks and then in rounds."""
    monkeypatch.setattr("tallyframe.llm.components.EDGES_IN_TASK", 40)
    rng = random.Random(9)
    path, names = list(range(50)), list(range(-500, 500))
    rng.shuffle(path)
    edges = [*zip(path, path[1:]), *((400, k) for k in range(401, 440)), (7, 7), (600, 600)]
    edges += [(-2 - k, -60 - k // 3) for k in range(40)] + edges[:20]
    rng.shuffle(edges)
    rng.shuffle(names)
    edges = [(names[a % 1000], names[b % 1000]) if rng.random() < 0.5 else (names[b % 1000], names[a % 1000]) for a, b in edges]
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = [(r.node, r.root) for r in components(spark.createDataFrame(edges, "a bigint, b bigint").coalesce(2)).collect()]
    assert sorted(got) == sorted(root.items())


def test_small_tables_write_few_files(spark):
    """However many shuffle partitions there are, files and tasks that write follow the rows."""
    import os
    from tallyframe.plans.lineage import scratch_dir

    rng, rows = random.Random(3), []
    for group in range(20):
        words = prose(rng, 60).split()
        for _ in range(3):
            words[rng.randrange(60)] = f"w{rng.randrange(1000)}"
            rows.append((len(rows), " ".join(words)))
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA).repartition(4)
    top = scratch_dir(spark).removeprefix("file:")
    kept, old = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}, set(os.listdir(top))
    before = {name: spark.conf.get(name) for name in kept}
    try:
        for name, value in kept.items():
            spark.conf.set(name, value)
        got = found(docs)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert got == Counter(jaccard_components(rows, 4, 85))
    made = [sum(f.startswith("part-") for f in os.listdir(f"{top}/{t}")) for t in set(os.listdir(top)) - old if t.startswith("table-")]
    assert len(made) > 8 and max(made) <= 2 * spark.sparkContext.defaultParallelism

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, most=16):
    """n, deviations, whitened rows and shares by numpy's own eigenvectors, for rows (id, vector)."""
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) and abs(c) < 2**56 for c in v)]
    lengths: dict[int, set] = {}
    for _, v in usable:
        lengths.setdefault(len(v), set()).add(tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v))
    size = max((k for k in lengths if k), key=lambda k: (len(lengths[k]), k), default=0)
    fit = sorted(lengths.get(size, []))
    n, total = len(fit), [sum(column) for column in zip(*fit)]
    y = np.array([[(n * a - s) / n for a, s in zip(x, total)] for x in fit]).reshape(n, size)
    values, vectors = np.linalg.eigh(y.T @ y / max(n, 1)) if size else (np.zeros(0), np.zeros((0, 0)))
    kept = [k for k in np.argsort(-values) if values[k] > values.sum() * 1e-13][:most]
    out = []
    for i, v in usable:
        if len(v) == size and kept:
            d = [n * (math.floor(64 * float(np.float32(c))) + 1_000_000) - s for c, s in zip(v, total)]
            white = (np.array(d) / n) @ vectors[:, kept] / np.sqrt(values[kept])
            out.append((i, sum(a * a for a in d), white))
    return n, out, values[kept] / values.sum() if kept else values[:0]


def agrees(found, rows):
    n, expected, shares = plain(rows)
    got: dict = {}
    for r in found:
        assert r.n == n and r.identity_error <= 1e-9
        assert abs(r.explained - shares[r.component - 1]) <= 1e-9 * shares[r.component - 1]
        got.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    assert len(found) == len(expected) * len(shares)
    # Signs are free, but the same for all rows.
    signs = np.zeros(len(shares))
    for i, deviation, white in expected:
        own = got[i, deviation if deviation < 2**63 else None]
        for k in range(len(shares)):
            nearest = min(own[k + 1], key=lambda w: abs(abs(w) - abs(white[k])))
            assert abs(abs(nearest) - abs(white[k])) <= 1e-6 * max(1, abs(white[k]))
            if abs(white[k]) > 1e-3:
                signs[k] = signs[k] or np.sign(nearest * white[k])
                assert signs[k] == np.sign(nearest * white[k])


@pytest.mark.parametrize("size, values", [(64, np.geomspace(1, 1e6, 64)), (30, np.geomspace(1e-6, 1e6, 30)), (40, np.r_[np.zeros(30), np.arange(1.0, 11)]), (3, [5.0, 2, 1])])
def test_components_against_eigh(size, values):
    rng = np.random.default_rng(size)
    q = np.linalg.qr(rng.standard_normal((size, size)))[0]
    matrix = (q * np.array(values)) @ q.T
    matrix = (matrix + matrix.T) / 2
    e, x = whitening.components(matrix)
    expected = np.sort(values)[::-1][: len(e)]
    assert len(e) == min(16, int((np.array(values) > 0).sum()))
    assert np.abs(e - expected).max() <= 1e-13 * expected[0]
    assert np.abs(matrix @ x - x * e).max() <= 1e-12 * expected[0]
    assert np.abs(x.T @ x - np.eye(len(e))).max() <= 1e-13


@pytest.mark.parametrize("values", [np.ones(40), np.r_[np.ones(30), np.full(34, 2.0)], np.r_[np.full(20, 1e-3), [1, 1, 1, 50]], np.linspace(1, 1.00001, 25)])
def test_equal_and_crowded_eigenvalues(values):
    rng = np.random.default_rng(len(values))
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    matrix = (q * values) @ q.T
    e, x = whitening.components((matrix + matrix.T) / 2)
    assert np.abs(e - np.sort(values)[::-1][:16]).max() <= 1e-12 * max(values)
    assert np.abs(x.T @ matrix @ x - np.diag(e)).max() <= 1e-12 * max(values)


def test_inertia_counts_what_is_below():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 30):
        m = rng.standard_normal((size, size))
        m = m + m.T
        if size == 2:
            m[0, 0] = m[1, 1] = 0.0  # needs a pivot of two rows
        for shift in (-2.5, 0.0, 0.7):
            assert whitening.inertia_below(m, shift) == int((np.linalg.eigvalsh(m) < shift).sum())


def test_intervals_hold_every_eigenvalue():
    values = np.sort(np.random.default_rng(4).random(60))[::-1]
    found = whitening.Spectrum(np.diag(values)).intervals(16)
    assert 16 <= sum(count for *_, count in found) <= 24
    assert all(count == ((values > low) & (values < high)).sum() for low, high, count in found)


def test_rows_of_all_kinds(spark):
    rng = random.Random(6)
    vector = lambda k=20: [rng.gauss(0, 1 + j / 3) for j in range(k)]
    twice = vector()
    rows = [(i, vector()) for i in range(120)] + [(i, twice) for i in range(200, 260)]
    rows += [(1, None), (2, [None] + vector(19)), (3, [float("nan")] * 20), (4, [float("inf")] + vector(19)), (5, []), (6, vector(7)), (None, vector()), (7, twice), (7, twice), (8, [1e30] + vector(19))]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(5)
    table = table.withColumns({"x": F.lit("own"), "length": F.lit(1.5), "n": F.lit(None).cast("int"), "component": F.lit("c")})
    found = whitening.whiten(table).collect()
    agrees(found, rows)
    assert {r.n for r in found} == {122}


def test_great_entries_keep_exact_deviations(spark):
    rows = [(i, [float(i * 2**40), float(i % 3)]) for i in range(9)]
    found = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect()
    assert any(r.deviation is None for r in found)
    small = [(i, [float(i * 2**17), float(i % 3)]) for i in range(9)]
    agrees(whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in small], SCHEMA)).collect(), small)


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 2.0], 0)], [(i, [1.0, 1.0], 0) for i in range(5)], [(1, None, 0)], [(1, [], 0)]])
def test_no_variance_no_rows(spark, rows):
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert found.count() == 0


def test_fewer_dimensions_than_components(spark):
    rows = [(i, [float(i), float(i), float(i * i % 7)]) for i in range(20)]
    found = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect()
    assert {r.component for r in found} == {1, 2}
    agrees(found, rows)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    agrees(whitening.op12_whitening(spark, folder).collect(), rows)

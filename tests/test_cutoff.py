"""The k-th smallest against sorted lists."""

import random

import pytest
from pyspark.sql import functions as F

from tallyframe.plans import cutoff
from tallyframe.plans.cutoff import Cut, cutoffs
from tallyframe.plans.inspect import plan_text


def plain(values, k):
    values = sorted(v for v in values if v is not None)
    if not 1 <= k <= len(values):
        return None
    return Cut(values[k - 1], k - values.index(values[k - 1]))


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("few", [0, 50])
def test_cuts_of_groups_of_all_shapes(spark, seed, few, monkeypatch):
    monkeypatch.setattr(cutoff, "FEW_ROWS", few)
    rng = random.Random(seed)
    groups = {
        "wide": [rng.randint(-2**63, 2**63 - 1) for _ in range(500)], "hot": [7] * 400 + [rng.randint(0, 20) for _ in range(100)],
        "near": list(range(1000, 1600)), "one": [5], None: [rng.randint(-10, 10) for _ in range(300)] + [None] * 3,
        "skewed": [int(rng.paretovariate(0.3)) % 10**15 for _ in range(600)], "none": [None],
    }
    rows = [(g, v) for g, values in groups.items() for v in values]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v bigint").repartition(5)
    for share in (0.0, 0.01, 0.5, 0.99, 1.0, 1.5):
        wanted = {g: round(len(values) * share) for g, values in groups.items()}
        assert cutoffs(df, "v", wanted, "g") == {g: plain(values, wanted[g]) for g, values in groups.items()}


def test_whole_table_without_a_sort(spark, monkeypatch):
    monkeypatch.setattr(cutoff, "FEW_ROWS", 0)
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).alias("v"))
    values = sorted(i * 7919 % 200_003 for i in range(200_000))
    plans = []
    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: (plans.append(plan_text(self)), collect(self))[1])
    assert cutoffs(df, "v", {None: 123_456})[None] == Cut(values[123_455], 1)
    assert 2 <= len(plans) <= 4 and not any("Sort" in p or "rangepartitioning" in p for p in plans)


def test_nothing_to_cut(spark):
    empty = spark.createDataFrame([], "g string, v bigint")
    assert cutoffs(empty, "v", {"a": 3}, "g") == {"a": None}
    assert cutoffs(empty, "v", {None: 3}) == {None: None}

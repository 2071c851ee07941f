"""Balanced forest on invented rows where one attribute decides."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import campaign, model


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    out = []
    for i in range(1500):
        y = int(rng.random() < 0.1)
        age = rng.gauss(5 if y else 2, 1)
        kind = rng.choice(["a", "b"]) if rng.random() > 0.004 else f"odd{i}"
        out.append((i, y, kind, None if rng.random() < 0.1 else age, rng.random()))
    return spark.createDataFrame(out, "id int, y int, kind string, age double, noise double")


def test_fit(rows):
    fitted = model.fit_drivers(rows, "id", "y", ["kind"], ["age", "noise"], trees=20)
    assert 0.85 < fitted.auc <= 1.0
    got = fitted.importances.collect()
    assert got[0].feature == "age"
    assert sum(r.importance for r in got) == pytest.approx(1.0)
    assert [r.importance for r in got] == sorted((r.importance for r in got), reverse=True)
    assert {r.feature for r in got} >= {"age", "noise", "kind=a"}


def test_rare_levels_share_a_name(rows):
    levels = model.common_levels(rows, ["kind"])
    assert levels == {"kind": ["a", "b"]}
    train = model.group_rare_levels(rows, levels)
    assert {r.kind for r in train.select("kind").distinct().collect()} == {"a", "b", model.RARE}
    later = rows.limit(2).withColumn("kind", F.when(F.col("id") > 0, "unseen"))
    assert {r.kind for r in model.group_rare_levels(later, levels).collect()} == {model.RARE}
    assert train.count() == 1500


def test_weights_balance_the_classes(rows):
    sums = model.balanced_weights(rows, "y").groupBy("y").agg(F.sum("weight").alias("w")).collect()
    assert [r.w for r in sums] == [pytest.approx(750.0)] * 2


def test_fit_in_a_session_that_has_observed_a_query(spark, rows):
    counted, seen = campaign.counted(spark.range(5), "before the fit")
    counted.collect()
    assert seen.get["rows"] == 5
    assert model.fit_drivers(rows, "id", "y", [], ["age"], trees=3).auc > 0.5


def plain_auc(rows):
    ones, zeros = [s for y, s in rows if y == 1], [s for y, s in rows if y == 0]
    won = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros)
    return won / (len(ones) * len(zeros)) if ones and zeros else None


@pytest.mark.parametrize("seed,steps", [(1, 3), (2, 40), (3, 10**9)])
def test_auc_counts_ties_half(spark, seed, steps):
    rng = random.Random(seed)
    rows = [(y, rng.randint(0, steps) + 0.3 * steps * y) for y in (int(rng.random() < 0.2) for _ in range(400))]
    df = spark.createDataFrame([(y, float(s)) for y, s in rows] + [(None, 1.0), (1, None)], "y int, s double")
    assert model.rank_sum_auc(df, "y", "s").first().auc == pytest.approx(plain_auc(rows), abs=1e-15)
    assert model.rank_sum_auc(df.filter("y = 1"), "y", "s").first().auc is None
    assert model.rank_sum_auc(df.limit(0), "y", "s").first().auc is None


def test_medians_of_several_columns(spark):
    rng = random.Random(2)
    columns = {"a": [rng.gauss(0, 1) for _ in range(501)], "b": [float(rng.randint(0, 4)) for _ in range(501)], "c": [None] * 501, "d": [1.0] + [None] * 500}
    columns["a"][5], columns["b"][7], columns["a"][9] = None, float("nan"), float("nan")
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    want = {c: statistics.median(v for v in values if v is not None and v == v) if any(v is not None for v in values) else None for c, values in columns.items()}
    got = model.medians(df, list(columns))
    assert got == want
    filled = model.fill_medians(df, got).collect()
    assert filled[5].a == filled[9].a == want["a"] and filled[7].b == want["b"] and filled[3].c is None and filled[0].d == 1.0


def test_sketches_kept_by_day_and_merged(spark):
    rng = random.Random(9)
    rows = [(d, rng.gauss(d, 10.0), float(rng.randint(0, 100))) for d in range(6) for _ in range(2000)]
    days = spark.createDataFrame(rows + [(1, None, float("nan"))], "day int, x double, y double")
    # A day's sketches are made by themselves; merged they stand for all days.
    kept = [model.daily_sketches(days.filter(F.col("day") == d), "day", ["x", "y"]) for d in range(6)]
    whole = kept[0]
    for more in kept[1:]:
        whole = whole.union(more)
    got = {r.column: (r.quantile, r.n) for r in model.sketched_quantiles(whole).collect()}
    for i, column in ((1, "x"), (2, "y")):
        values = sorted(r[i] for r in rows)
        rank = sum(v <= got[column][0] for v in values) / len(values)
        assert got[column][1] == 12_000 and 0.48 < rank < 0.53

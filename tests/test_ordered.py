"""Whole-table order: numbers, running totals, medians, cool-down; each against brute force."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import alerts
from tallyframe.operators.model import stratified_split
from tallyframe.operators.ranking import rank_with_ties, rank_within
from tallyframe.plans.inspect import plan_text
from tallyframe.plans.ordered import exact_median, number_rows, running_total


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """No coalescing: tiny inputs still spread over several ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_numbers_are_gap_free_and_in_key_order(spark):
    keys = random.Random(1).sample(range(10**9), 5000)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = number_rows(df, "k", into="n", start=101).collect()
    assert {r.k: r.n for r in got} == {k: 101 + i for i, k in enumerate(sorted(keys))}


def test_numbers_on_empty_and_null_keys(spark):
    empty = spark.createDataFrame([], "k bigint")
    assert number_rows(empty, "k").count() == 0
    some = spark.createDataFrame([(None,), (3,), (1,)], "k bigint")
    assert {r.k: r.row_num for r in number_rows(some, "k").collect()} == {None: 1, 1: 2, 3: 3}


def test_numbers_have_no_single_task_window(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    plan = plan_text(number_rows(df, "k"), "simple")
    above, below = plan.split("SinglePartition")
    # What comes together in one task is the count per range.
    assert "HashAggregate(keys=[__range" in below.splitlines()[1]
    assert "BroadcastExchange" in above


def test_running_total(spark):
    rng = random.Random(2)
    rows = [(i, rng.randint(-5, 50)) for i in range(3000)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    got = running_total(spark.createDataFrame(shuffled, "k bigint, v bigint"), "v", "k").collect()
    want, upto = {}, 0
    for k, v in rows:
        upto += v
        want[k] = upto
    assert {r.k: r.running for r in got} == want


@pytest.mark.parametrize("seed", range(4))
def test_median_with_a_hot_group_and_a_hot_value(spark, seed):
    rng = random.Random(seed)
    rows = [("hot", 7.0) for _ in range(900)]
    rows += [("hot", float(rng.randint(0, 100))) for _ in range(rng.randint(300, 1500))]
    rows += [(rng.choice("abc"), float(rng.randint(0, 9))) for _ in range(200)]
    rows += [(None, 1.0), (None, 4.0), ("one", 5.0), ("gap", None)]
    got = exact_median(spark.createDataFrame(rows, "g string, v double"), "v", "g").collect()
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert {r.g: r.median for r in got} == {g: statistics.median(v) for g, v in groups.items()}


def fires(rows, limit, wait):
    """Plain loop over sorted samples."""
    out, last = set(), {}
    for key, i, ts, value in sorted(rows, key=lambda r: (str(r[0]), r[2], r[1])):
        if value > limit and (key not in last or ts >= last[key] + wait):
            out.add((key, i))
            last[key] = ts
    return out


@pytest.mark.parametrize("seed,span", [(1, 2_000), (2, 20_000), (3, 200_000), (4, 300)])
def test_cool_down_with_a_series_over_many_ranges(spark, seed, span, monkeypatch):
    monkeypatch.setattr(alerts, "ROWS_PER_RANGE", 40)
    rng = random.Random(seed)
    rows = [
        ("hot" if rng.random() < 0.5 else rng.choice([None, None, *"abcdef"]), i, rng.randint(0, span),
         float(rng.randint(60, 100)))
        for i in range(4000)
    ]
    df = spark.createDataFrame(rows, "s string, event_id bigint, sec bigint, value double")
    df = df.withColumn("ts", F.timestamp_seconds("sec")).drop("sec")
    got = {(r.s, r.event_id) for r in alerts.cool_down(df, "s", 75, 60).collect()}
    assert got == fires(rows, 75, 60)


def as_samples(spark, rows):
    df = spark.createDataFrame(rows, "s string, event_id bigint, sec bigint, value double")
    return df.withColumn("ts", F.timestamp_seconds("sec")).drop("sec")


@pytest.mark.parametrize("gap,wait", [(1, 7), (1, 700), (7, 60), (60, 60), (61, 60), (59, 60)])
def test_cool_down_of_one_evenly_spaced_series(spark, gap, wait, monkeypatch):
    """The paths of its samples never meet, so every range needs what all before it did."""
    monkeypatch.setattr(alerts, "ROWS_PER_RANGE", 20)
    largest = []
    composed = alerts._compose_pairs

    def watched(steps, wait):
        sides = steps.groupBy("__series", F.shiftright("node", 1)).agg(F.count_distinct("node").alias("n"))
        largest.append(sides.agg(F.max("n")).first()[0])
        return composed(steps, wait)

    monkeypatch.setattr(alerts, "_compose_pairs", watched)
    rows = [("s", i, i * gap, 99.0) for i in range(64 * 20)] + [("t", 1, 5, 99.0), ("u", 2, 5, 10.0)]
    fired = alerts.cool_down(as_samples(spark, rows), "s", 75, wait)
    assert {(r.s, r.event_id) for r in fired.collect()} == fires(rows, 75, wait)
    # 64 ranges become one function in six or seven rounds, two neighbours at a time.
    assert 6 <= len(largest) <= 7 and max(largest) == 2


def test_cool_down_without_crossings_or_without_quiet(spark):
    rows = [("s", i, i // 2, 99.0) for i in range(10)]
    none = as_samples(spark, rows).filter("value < 0")
    assert alerts.cool_down(none, "s").count() == 0
    assert alerts.cool_down(as_samples(spark, rows), "s", 75, 0).count() == 10


def test_split_is_exact_per_class_and_repeats(spark):
    rows = [(i, 1 if i < 61 else 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "id bigint, y int")
    first = stratified_split(df, "id", "y").collect()
    assert sum(r.is_test for r in first if r.y == 1) == 13
    assert sum(r.is_test for r in first if r.y == 0) == 188
    again = stratified_split(df.repartition(3), "id", "y").collect()
    assert {(r.id, r.is_test) for r in first} == {(r.id, r.is_test) for r in again}
    other = stratified_split(df, "id", "y", seed=7).collect()
    assert {(r.id, r.is_test) for r in first} != {(r.id, r.is_test) for r in other}


def test_median_when_the_sketch_misses(spark, monkeypatch):
    rng = random.Random(5)
    rows = [("g", float(rng.randint(0, 10**6))) for _ in range(801)]
    rows += [("h", float(rng.randint(0, 10**6))) for _ in range(600)]
    df = spark.createDataFrame(rows, "g string, v double")
    real = F.percentile_approx
    for off in ([0.8, 0.9], [0.1, 0.2], [0.5001, 0.5002]):
        monkeypatch.setattr(F, "percentile_approx", lambda c, _, a, off=off: real(c, off, a))
        got = {r.g: r.median for r in exact_median(df, "v", "g").collect()}
        want = {k: statistics.median(v for g, v in rows if g == k) for k in "gh"}
        assert got == want


@pytest.mark.parametrize("largest", [True, False])
def test_ranks_of_values_that_most_rows_share(spark, largest):
    rng = random.Random(4)
    rows = [("hot", 5.0 if rng.random() < 0.9 else float(rng.randint(0, 9)), i) for i in range(1000)]
    rows += [(None, float(rng.randint(0, 3)), i) for i in range(20)] + [("gap", None, 1), ("gap", 2.0, 2), ("none", None, 3), ("none", None, 4)]
    df = spark.createDataFrame(rows, "k string, v double, i int").repartition(4)
    order = F.col("v").desc_nulls_last() if largest else F.col("v").asc_nulls_last()
    for places in (1, 3, 50):
        want = rank_within(df, ["k"], [order], places).collect()
        got = rank_with_ties(df, ["k"], "v", places, largest=largest)
        assert got.columns == ["k", "v", "i", "rk"]
        assert sorted(map(str, got.collect())) == sorted(map(str, want))


def test_tied_rows_do_not_meet_in_a_window(spark):
    """A value in 90 % of a group: the windows get distinct values only, cut before the shuffle."""
    df = spark.range(50_000).select(F.lit("k").alias("k"), F.when(F.col("id") % 10 > 0, 7).otherwise(F.col("id")).alias("v"))
    ranked = rank_with_ties(df, ["k"], "v", 3)
    text = plan_text(ranked)
    assert text.index("WindowGroupLimit") < text.index("Window [") if "Window [" in text else "WindowGroupLimit" in text
    limit = [line for line in text.splitlines() if "Window" in line]
    assert limit and "partial_count" in text.lower()
    assert ranked.count() == rank_within(df, ["k"], [F.col("v").desc()], 3).count()


def test_rolled_windows_from_one_scan(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), i, rng.randint(0, 20_000), rng.choice([0.1, 0.2, 50.0, None, 1e9])) for i in range(800)]
    once = as_samples(spark, rows)
    again = as_samples(spark, rows + rows[:300] + rows[:50])
    rolled = alerts.rolled_means(again, "s", ["5 seconds", "10 seconds", "1 hour"])
    for width, got in rolled.items():
        want = alerts.window_means(once.withColumn("value", F.col("value").cast("decimal(20,8)")), "s", width)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

"""Correlations of many columns and duplicates of wide rows."""

import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import profiling
from tallyframe.plans.inspect import plan_text


def cells(frame):
    return {(r.a, r.b): r.r for r in frame.collect()}


@pytest.fixture(scope="module")
def gaps(spark):
    rng = random.Random(1)
    base = [rng.gauss(1e6, 3) for _ in range(400)]
    columns = {
        "x": base, "y": [b * -2 + rng.gauss(0, 1) for b in base], "z": [rng.random() for _ in base], "flat": [4.0] * 400, "none": [None] * 400,
        "nan": [float("nan") if i % 3 else b for i, b in enumerate(base)], "half": [b if i % 2 else None for i, b in enumerate(base)], "other": [b if i % 2 == 0 else None for i, b in enumerate(base)],
    }
    return spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)), list(columns)


def test_blocks_agree_with_expressions(gaps):
    df, columns = gaps
    want, got = cells(profiling.correlation_matrix(df, columns)), cells(profiling.correlation_blocks(df, columns))
    assert set(want) == set(got) and len(got) == len(columns) ** 2
    for pair, r in want.items():
        plain = lambda v: None if v is None or v != v else v
        assert plain(got[pair]) == pytest.approx(plain(r), abs=2e-6) if plain(r) is not None else plain(got[pair]) is None, pair


def test_three_hundred_columns(spark):
    df = spark.range(500, numPartitions=4)
    df = df.select(*[(F.sin(F.col("id") * (k + 1)) + (F.col("id") * (k % 3))).alias(f"c{k}") for k in range(300)])
    got = cells(profiling.correlation_matrix(df, df.columns))
    assert len(got) == 90_000
    few = cells(profiling.correlation_matrix(df, ["c0", "c1", "c298", "c299"]))
    assert all(got[pair] == pytest.approx(r, abs=2e-6) for pair, r in few.items())


def test_report_of_wide_rows(spark):
    rng = random.Random(3)
    rows = [(i % 7, rng.choice(["a", None]), rng.choice([0.0, -0.0, float("nan"), None]), rng.choice([None, "a"]), "x" * 50, b"\x00" if i % 2 else None) for i in range(900)]
    rows += [rows[0]] * 300
    df = spark.createDataFrame(rows, "i int, s string, d double, t string, w string, b binary").repartition(6)
    report = profiling.duplicate_report(df)
    distinct = df.distinct().count()
    assert tuple(report.first()) == (1200, distinct, 1200 - distinct)
    alone = df.withColumn("i", F.monotonically_increasing_id())
    assert tuple(profiling.duplicate_report(alone).first()) == (1200, 1200, 0)
    assert tuple(profiling.duplicate_report(df.limit(0)).first()) == (0, 0, 0)


def test_rows_with_one_print_are_compared(spark, monkeypatch):
    """Prints that all collide: the columns decide."""
    monkeypatch.setattr(profiling, "_prints", lambda df: {"__p1": F.lit(1), "__p2": F.lit(2)})
    df = spark.createDataFrame([(k % 5, "a", "b", "c", "d") for k in range(40)], "i int, p string, q string, r string, s string")
    assert tuple(profiling.duplicate_report(df).first()) == (40, 5, 35)


def test_only_prints_are_shuffled(spark):
    df = spark.range(1000).select(*[F.concat(F.lit("w" * 40), F.col("id")).alias(f"c{k}") for k in range(8)])
    marked = df.withColumns(profiling._prints(df)).groupBy("__p1", "__p2").count()
    exchange = plan_text(marked).split("Exchange\n")[1].split("\n")[1]
    assert "__p1" in exchange and "c7" not in exchange

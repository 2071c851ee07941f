"""Streams give what their batch twins give, however samples are dealt to triggers."""

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import alerts
from tallyframe.streaming import alerts as live

LATE = "3 hours"


@pytest.fixture(scope="module")
def feed(spark, tables, tmp_path_factory):
    """Events out of order by up to two hours, in several files, read one file per trigger.

    A last event, long after the others and under every limit, moves the watermark past them.
    """
    folder = str(tmp_path_factory.mktemp("feed"))
    events = tables.events.withColumn("ts", F.col("ts").cast("timestamp")).drop("props")
    shaken = events.withColumn("at", F.unix_timestamp("ts") + F.pmod(F.xxhash64("event_id"), F.lit(7200)))
    bounds = shaken.approxQuantile("at", [0.0, 0.2, 0.4, 0.6, 0.8, 1.0], 0)
    for low, high in zip(bounds, bounds[1:]):
        last = F.col("at") <= high if high == bounds[-1] else F.col("at") < high
        part = shaken.filter((F.col("at") >= low) & last).drop("at")
        part.orderBy(F.rand(3)).coalesce(1).write.mode("append").parquet(folder)
    end = events.orderBy(F.desc("ts")).limit(1)
    end = end.withColumns({"ts": F.col("ts") + F.expr("interval 60 days"), "value": F.lit(0.0), "event_id": F.lit(-1).cast("bigint"), "event_type": F.lit("end")})
    end.select(*events.columns).coalesce(1).write.mode("append").parquet(folder)
    return events, folder


def run(spark, stream, tmp_path, name, mode="append"):
    query = (
        stream.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", str(tmp_path / name))
        .trigger(availableNow=True).start()
    )
    try:
        query.awaitTermination(180)
        assert query.exception() is None
    finally:
        query.stop()
    return spark.table(name)


def open_feed(spark, feed):
    return live.read_samples(spark, feed[1], feed[0].schema, files_per_trigger=1)


def rows(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


def test_every_crossing(spark, feed, tmp_path):
    out = run(spark, alerts.every_crossing(open_feed(spark, feed)), tmp_path, "every")
    assert rows(out, "event_id") == rows(alerts.every_crossing(feed[0]), "event_id")


def state_rows(spark, tmp_path, name, *variables, step=0):
    """Rows of state variables and timers that are left at the end."""
    reader = lambda: spark.read.format("statestore").option("operatorId", step)
    place = str(tmp_path / name)
    return [reader().option("stateVarName", v).load(place).count() for v in variables] + [
        reader().option("readRegisteredTimers", True).load(place).count()
    ]


@pytest.mark.parametrize("salts", [1, 3])
def test_first_crossing_fires_once(spark, feed, tmp_path, salts):
    name = f"first_{salts}"
    stream = live.first_crossing(open_feed(spark, feed), "event_type", late=LATE, forget=None, salts=salts)
    out = run(spark, stream, tmp_path, name)
    want = alerts.first_crossing(feed[0], "event_type")
    assert rows(out, "event_type", "ts") == rows(want, "event_type", "first_ts")


def test_first_crossing_again_after_silence(spark, feed, tmp_path):
    stream = live.first_crossing(open_feed(spark, feed), "event_type", late=LATE, forget=5 * 86_400)
    out = run(spark, stream, tmp_path, "first_again")
    want = alerts.cool_down(feed[0], "event_type", seconds=5 * 86_400)
    assert rows(out, "event_type", "event_id") == rows(want, "event_type", "event_id")
    assert state_rows(spark, tmp_path, "first_again", "waiting", "fired", "due") == [0, 0, 0, 0]


@pytest.mark.parametrize("seconds", [1800, 60])
def test_cool_down(spark, feed, tmp_path, seconds):
    name = f"cool_{seconds}"
    stream = live.cool_down(open_feed(spark, feed), "event_type", seconds=seconds, late=LATE)
    out = run(spark, stream, tmp_path, name)
    want = alerts.cool_down(feed[0], "event_type", seconds=seconds)
    got = rows(out, "event_type", "event_id")
    assert got == rows(want, "event_type", "event_id")
    assert 0 < len(got) <= alerts.every_crossing(feed[0]).count()
    assert state_rows(spark, tmp_path, name, "waiting", "last", "due") == [0, 0, 0, 0]


@pytest.mark.parametrize("salts", [1, 3])
def test_last_points_as_the_watermark_passes(spark, feed, tmp_path, salts):
    name = f"points_{salts}"
    stream = live.last_points(open_feed(spark, feed), "event_type", 20, late=LATE, forget=30 * 86_400, salts=salts)
    out = run(spark, stream, tmp_path, name)
    own = out.filter("event_type <> 'end'")
    final = alerts.last_points(own.dropDuplicates(["event_id"]), "event_type", 20)
    want = alerts.last_points(feed[0], "event_type", 20)
    assert rows(final, "event_type", "event_id") == rows(want, "event_type", "event_id")
    # Every sample that was ever among the last is shown; nothing is shown before its time.
    shown = own.groupBy("event_type").count().collect()
    assert all(20 <= r["count"] <= 20 * 7 for r in shown)


def test_samples_in_any_order_within_the_delay(spark, feed, tmp_path):
    """All files in one trigger, or one at a time: the same alerts."""
    stream = live.read_samples(spark, feed[1], feed[0].schema, files_per_trigger=100)
    out = run(spark, live.cool_down(stream, "event_type", seconds=1800, late=LATE), tmp_path, "whole")
    want = alerts.cool_down(feed[0], "event_type", seconds=1800)
    assert rows(out, "event_type", "event_id") == rows(want, "event_type", "event_id")


def test_windows_closed_by_the_watermark(spark, feed, tmp_path):
    stream = live.windowed_means(open_feed(spark, feed), "event_type", "1 hour", LATE)
    out = run(spark, stream, tmp_path, "windows")
    want = {
        (r.start, r.event_type): (r.mean, r.samples)
        for r in alerts.window_means(feed[0], "event_type", "1 hour").collect()
    }
    got = {(r.start, r.event_type): (r.mean, r.samples) for r in out.collect()}
    assert got and all(want[k] == v for k, v in got.items())
    # The last event closes every window but its own.
    assert set(got) == set(want)

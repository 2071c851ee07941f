"""Alert rules on event streams.

A stream has ``ts`` (timestamp), ``event_id``, ``value`` and a series column.
``every_crossing`` and ``window_means`` of ``operators.alerts`` are stateless or
built-in and take streams as they are; the rules here keep state per series.

Samples may come in any order within ``late`` of the newest one. They are held
until the watermark has passed them, so what fires does not depend on how they
were dealt to triggers: on samples in time the stream gives what its batch twin
gives. Samples later than that are dropped. Event-time timers do the work and
also end the state: a quiet series holds none once its rule no longer needs it.

Samples that cannot matter are filtered out before the shuffle. First crossing
and last points work on slices of a series before they bring it together. The
cool-down cannot be sliced, so it keeps the crossings of one series and of the
time ``late`` in a task: bound a trigger with ``maxFilesPerTrigger`` or the
source's own limit. At rest ``operators.alerts`` has a form that spreads one
series over any number of tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyframe.operators.alerts import COOL_DOWN, LIMIT, POINTS, _fired, window_means

_SALT = "__salt"

#: How late a sample may come, and seconds after which a silent series leaves the state.
LATE = "10 minutes"
FORGET = 7 * 86_400


def read_samples(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1000
) -> DataFrame:
    """Parquet files arriving in a folder, with ``ts`` as a timestamp a watermark can use."""
    stream = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_means(samples: DataFrame, key: str, width: str, late: str) -> DataFrame:
    """Means of windows that are closed: samples later than ``late`` are dropped."""
    return window_means(samples.withWatermark("ts", late), key, width)


def rolled_means(samples: DataFrame, key: str, fine: str, coarse: str, late: str) -> DataFrame:
    """Means of wide windows out of sums of narrow ones; a sample that is sent again within ``late`` counts once."""
    once = samples.withWatermark("ts", late).dropDuplicatesWithinWatermark([key, "event_id"])
    grains = once.groupBy(F.window("ts", fine), key).agg(
        F.sum(F.col("value").cast("decimal(24,8)")).alias("sum"), F.count("value").alias("n"), F.count(F.lit(1)).alias("samples")
    )
    sums = grains.groupBy(F.window(F.window_time("window"), coarse), key).agg(
        F.round(F.try_divide(F.sum("sum").cast("double"), F.sum("n")), 6).alias("mean"), F.sum("samples").cast("bigint").alias("samples")
    )
    return sums.select(F.col("window.start").alias("start"), key, "mean", "samples")


def _crossings(samples: DataFrame, key: str, limit: float, late: str) -> DataFrame:
    """Samples above the limit, under a watermark that all samples move.

    The condition names the time as well, or it would be moved before the
    watermark, which would then stand still while nothing crosses.
    """
    hits = samples.withWatermark("ts", late).filter(F.when(F.col("ts").isNotNull(), F.col("value") > limit))
    return hits.select(key, "event_id", "ts", "value")


def _stateful(
    samples: DataFrame, keys: list[str], processor: StatefulProcessor, out: T.StructType, goes_on: bool = False
) -> DataFrame:
    """``goes_on``: another rule follows, for which ``ts`` stays the time under the watermark."""
    return samples.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=out,
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName="ts" if goes_on else "",
    )


def _in_two_steps(
    samples: DataFrame, key: str, processor: Callable[[bool], StatefulProcessor], salts: int
) -> DataFrame:
    """The rule per slice of a series first, then over what the slices give out.

    For rules where the answer over all is the answer over the slices' answers.
    A busy series is worked on by ``salts`` tasks, and few rows go on.
    """
    out = _fired_type(samples, key)
    if salts > 1:
        salted = samples.withColumn(_SALT, F.pmod(F.xxhash64("event_id"), F.lit(salts)))
        samples = _stateful(salted, [key, _SALT], processor(True), out, goes_on=True)
    return _stateful(samples, [key], processor(False), out)


def _fired_type(samples: DataFrame, key: str) -> T.StructType:
    return T.StructType([T.StructField(c, samples.schema[c].dataType) for c in (key, "event_id", "ts", "value")])


def _micros(ts: pd.Series) -> pd.Series:
    """Times as whole microseconds: what the state stores, free of time zones."""
    return ts.astype("datetime64[us]").astype("int64")


def _held(batch: pd.DataFrame) -> pd.DataFrame:
    return batch[["event_id", "value"]].assign(us=_micros(batch["ts"]))


def _passed_at(us: int) -> int:
    """The watermark, in milliseconds, that has passed a time."""
    return -(-int(us) // 1000)


class _Rule(StatefulProcessor):
    """What the rules share: samples held until the watermark, and one timer.

    ``settled`` gets the samples that no more can come before, in time order,
    and says when it wants to be called again without any (microseconds), or
    None if nothing is left to do; then the state is empty.
    """

    HELD = "event_id bigint, us bigint, value double"

    def __init__(self, key: str):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.HELD)
        self.due = handle.getValueState("due", "ms bigint")

    def _wake(self, ms: int | None) -> None:
        """Have one timer, at the given time."""
        set_for = self.due.get()[0] if self.due.exists() else None
        if set_for == ms:
            return
        if set_for is not None:
            self.handle.deleteTimer(set_for)
        if ms is None:
            self.due.clear()
        else:
            self.handle.registerTimer(ms)
            self.due.update((ms,))

    def thinned(self, rows: pd.DataFrame) -> pd.DataFrame:
        """The held samples that can still matter."""
        return rows

    def _waiting(self) -> pd.DataFrame:
        rows = list(self.waiting.get()) if self.waiting.exists() else []
        return pd.DataFrame(rows, columns=["event_id", "us", "value"])

    def _hold(self, rows: pd.DataFrame) -> None:
        if rows.empty:
            self.waiting.clear()
        else:
            self.waiting.put([(int(i), int(us), float(v)) for i, us, v in rows[["event_id", "us", "value"]].itertuples(index=False)])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self._waiting()
        for batch in rows:
            new = _held(batch)
            held = self.thinned(new if held.empty else pd.concat([held, new]))
        self._hold(held)
        ms = _passed_at(held["us"].min())
        set_for = self.due.get()[0] if self.due.exists() else None
        self._wake(ms if set_for is None else min(ms, set_for))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.due.clear()
        now = timerValues.getCurrentWatermarkInMs() * 1000
        held = self._waiting().sort_values(["us", "event_id"])
        ready, rest = held[held["us"] <= now], held[held["us"] > now]
        again, out = self.settled(ready, now)
        self._hold(rest)
        wakes = ([_passed_at(rest["us"].min())] if len(rest) else []) + ([_passed_at(again)] if again is not None else [])
        self._wake(min(wakes) if wakes else None)
        if len(out):
            out = out.assign(ts=out["us"].astype("int64").astype("datetime64[us]"))
            out[self.key] = key[0]
            yield out[[self.key, "event_id", "ts", "value"]]

    def close(self) -> None:
        pass


def _in_seconds(seconds: float | None) -> int | None:
    return None if seconds is None else int(seconds * 1_000_000)


class _First(_Rule):
    """Fires a series at its earliest crossing, then not before it is forgotten."""

    def __init__(self, key: str, forget: float | None):
        super().__init__(key)
        self.forget = _in_seconds(forget)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.fired = handle.getValueState("fired", "us bigint")

    def thinned(self, rows: pd.DataFrame) -> pd.DataFrame:
        # With a time to forget, a later crossing may be the first of the next alert.
        return rows if self.forget is not None else rows.sort_values(["us", "event_id"]).head(1)

    def settled(self, ready: pd.DataFrame, now: int) -> tuple[int | None, pd.DataFrame]:
        last = self.fired.get()[0] if self.fired.exists() else None
        if self.forget is None:
            out = ready.head(1 if last is None else 0)
        else:
            out = ready[_fired(ready["us"].to_numpy(np.int64), self.forget, np.nan if last is None else float(last + self.forget))]
        if len(out):
            last = int(out["us"].iloc[-1])
            self.fired.update((last,))
        if last is None or self.forget is None:
            return None, out
        if last + self.forget <= now:
            self.fired.clear()
            return None, out
        return last + self.forget, out


def first_crossing(
    samples: DataFrame, key: str, limit: float = LIMIT, late: str = LATE, forget: float | None = FORGET, salts: int = 8
) -> DataFrame:
    """One alert per series, then silence for ``forget`` seconds after it; for ever if None.

    Only with None does a series that fired stay in the state, as one number.
    """
    hits = _crossings(samples, key, limit, late)
    # What a slice holds back in its silence, the whole series would too only if the slice fired last: no slices then.
    return _in_two_steps(hits, key, lambda _: _First(key, forget), salts if forget is None else 1)


class _CoolDown(_Rule):
    """Fires unless the series fired within ``seconds``; the last fire is forgotten after that."""

    def __init__(self, key: str, seconds: int):
        super().__init__(key)
        self.wait = _in_seconds(seconds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "us bigint")

    def settled(self, ready: pd.DataFrame, now: int) -> tuple[int | None, pd.DataFrame]:
        last = self.last.get()[0] if self.last.exists() else None
        free_at = np.nan if last is None else float(last + self.wait)
        out = ready[_fired(ready["us"].to_numpy(np.int64), self.wait, free_at)]
        if len(out):
            last = int(out["us"].iloc[-1])
            self.last.update((last,))
        if last is None or last + self.wait <= now:
            self.last.clear()
            return None, out
        return last + self.wait, out


def cool_down(
    samples: DataFrame, key: str, limit: float = LIMIT, seconds: int = COOL_DOWN, late: str = LATE
) -> DataFrame:
    """Crossings with at least ``seconds`` between two fires of a series."""
    hits = _crossings(samples, key, limit, late)
    return _stateful(hits, [key], _CoolDown(key, seconds), _fired_type(hits, key))


class _LastPoints(_Rule):
    """Keeps the latest points of a series and gives them out when the watermark has passed new ones.

    Of a slice only the new ones are given out; the rest has gone on before.
    """

    def __init__(self, key: str, points: int, forget: float, of_slice: bool):
        super().__init__(key)
        self.points, self.of_slice = points, of_slice
        self.forget = _in_seconds(forget)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.kept = handle.getListState("kept", self.HELD)

    def settled(self, ready: pd.DataFrame, now: int) -> tuple[int | None, pd.DataFrame]:
        rows = list(self.kept.get()) if self.kept.exists() else []
        kept = pd.DataFrame(rows, columns=["event_id", "us", "value"])
        best = ready if kept.empty else pd.concat([kept, ready]) if len(ready) else kept
        best = best.sort_values(["us", "event_id"], ascending=False).head(self.points)
        shown = best[best["event_id"].isin(ready["event_id"])] if self.of_slice else best.head(len(best) if len(ready) else 0)
        ends = int(best["us"].max()) + self.forget if len(best) else None
        if ends is None or ends <= now:
            self.kept.clear()
            return None, shown
        self.kept.put([(int(i), int(us), float(v)) for i, us, v in best[["event_id", "us", "value"]].itertuples(index=False)])
        return ends, shown


def last_points(
    samples: DataFrame, key: str, points: int = POINTS, late: str = LATE, forget: float = FORGET, salts: int = 8
) -> DataFrame:
    """The latest points of each series the watermark has passed, whenever it passes new ones.

    A series without samples for ``forget`` seconds leaves the state.
    """
    rows = samples.withWatermark("ts", late).select(key, "event_id", "ts", "value")
    return _in_two_steps(rows, key, lambda of_slice: _LastPoints(key, points, forget, of_slice), salts)

"""Alert rules over samples at rest. The streaming forms are in ``streaming.alerts``."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from tallyframe.functions.numbers import exact
from tallyframe.operators.ranking import newest
from tallyframe.plans.lineage import materialize

# Alert limit in percent, cool-down in seconds, points kept per series.
LIMIT = 75
COOL_DOWN = 60
POINTS = 20


def every_crossing(samples: DataFrame, limit: float = LIMIT) -> DataFrame:
    """Every sample above the limit; works on streams too."""
    return samples.filter(F.col("value") > limit)


def first_crossing(samples: DataFrame, key: str, limit: float = LIMIT) -> DataFrame:
    """Time of the first sample above the limit per series."""
    return every_crossing(samples, limit).groupBy(key).agg(F.min("ts").alias("first_ts"))


def window_means(samples: DataFrame, key: str, width: str, places: int = 6) -> DataFrame:
    """Mean and count per series and tumbling window."""
    return (
        samples.groupBy(F.window("ts", width), key)
        .agg(
            F.round(F.avg("value").cast("double"), places).alias("mean"), F.count(F.lit(1)).alias("samples")
        )
        .select(F.col("window.start").alias("start"), key, "mean", "samples")
    )


def rolled_means(
    samples: DataFrame, key: str, widths: Sequence[str], grain: str = "1 second", places: int = 6
) -> dict[str, DataFrame]:
    """:func:`window_means` of several widths from one scan; a sample sent twice counts once.

    Samples are told apart by series, ``event_id`` and ``ts``. They are summed
    by the finest grain, which is written, and every width adds grains up, so
    each must be a multiple of the grain. Floating values are added as decimals
    of eight places, or a mean would depend on how grains are summed.
    """
    kind = dict(samples.dtypes)["value"]
    once = samples.groupBy(key, "event_id", "ts").agg(F.min("value").alias("value"))
    grains = materialize(
        once.groupBy(F.window("ts", grain), key)
        .agg(F.sum(exact(F.col("value"), kind)).alias("sum"), F.count("value").alias("n"), F.count(F.lit(1)).alias("samples"))
        .select(F.col("window.start").alias("ts"), key, "sum", "n", "samples")
    )

    def rolled(width: str) -> DataFrame:
        mean = F.try_divide(F.sum("sum").cast("double"), F.sum("n"))
        sums = grains.groupBy(F.window("ts", width), key).agg(
            F.round(mean, places).alias("mean"), F.sum("samples").cast("bigint").alias("samples")
        )
        return sums.select(F.col("window.start").alias("start"), key, "mean", "samples")

    return {width: rolled(width) for width in widths}


def last_points(samples: DataFrame, key: str, points: int = POINTS) -> DataFrame:
    """The latest points per series; cut per task before the shuffle."""
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    return newest(samples, [key], order, points)


# --- cool-down -------------------------------------------------------------
#
# After an alert a series stays quiet for a while, so whether a sample fires
# depends on all fires before it. Going through a series in one task would put
# a busy series there whole. Instead the crossings are cut into time-ordered
# ranges of even size, whatever the series. What a range does with a quiet
# period reaching into it depends only on when that period ends: a step
# function "period ends by x -> last fire at y". Neighbours' functions are
# composed two by two, in rounds, up to one for the whole series; going down
# again, each function gives the start of what follows it. Then all ranges fire
# on their own. Only a series that runs over a range's end takes part.


#: Crossings that one task holds at once in the cool-down rule.
ROWS_PER_RANGE = 200_000

_STEPS = "__series string, node bigint, first bigint, upto bigint, exit bigint"


def _next_allowed(times: np.ndarray, wait: int) -> np.ndarray:
    """For each fire the place of the next one: the first time at least ``wait`` later."""
    return np.searchsorted(times, times + wait, side="left")


def _last_fire(times: np.ndarray, wait: int) -> np.ndarray:
    """For each sample, the last fire of the run if it fires itself."""
    size = len(times)
    jump = _next_allowed(times, wait)
    jump = np.where(jump < size, jump, np.arange(size))
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            return times[jump]
        jump = further


def _fired(times: np.ndarray, wait: int, free_at: float) -> np.ndarray:
    """Whether each sample fires, when a quiet period ends at ``free_at`` (NaN: there is none)."""
    size = len(times)
    start = 0 if np.isnan(free_at) else int(np.searchsorted(times, int(free_at), side="left"))
    # Every fire leads to the next; steps of double length mark twice as many. The last place is the end.
    jump = np.append(_next_allowed(times, wait), size)
    reached = np.zeros(size + 1, bool)
    reached[start] = True
    while not (jump == size).all():
        reached[jump[reached]] = True
        jump = jump[jump]
    return reached[:size]


def _step_rows(first: int, upto: np.ndarray, exits: np.ndarray) -> pd.DataFrame:
    """One row for each stretch with the same exit, under its last entry."""
    ends = np.append(np.flatnonzero(exits[1:] != exits[:-1]), len(exits) - 1)
    return pd.DataFrame({"first": first, "upto": upto[ends], "exit": exits[ends]})


def _composed(a: pd.DataFrame, b: pd.DataFrame, wait: int) -> pd.DataFrame:
    """The function of two neighbours: what leaves ``a`` enters ``b``.

    It is needed for quiet periods that end by the first sample plus ``wait``,
    as no earlier fire can ask for more; rows beyond that are left out.
    """
    a, b = a.sort_values("upto"), b.sort_values("upto")
    entries, exits = a["upto"].to_numpy(), a["exit"].to_numpy()
    into, out = b["upto"].to_numpy(), b["exit"].to_numpy()
    place = np.searchsorted(into, exits + wait, side="left")
    exits = np.where(place < len(into), out[np.minimum(place, len(into) - 1)], exits)
    # A period that outlasts ``a`` goes on into ``b`` as it is.
    first = int(a["first"].iloc[0])
    if entries[-1] < first + wait:
        # The steps of ``b`` that begin within reach.
        later = np.append(-np.inf, into[:-1]) < first + wait
        entries, exits = np.append(entries, into[later]), np.append(exits, out[later])
    return _step_rows(first, entries, exits)


def _compose_pairs(steps: DataFrame, wait: int) -> DataFrame:
    """The next round: nodes 2k and 2k + 1 of a series as node k; a last one without a partner stays."""

    def compose(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        sides = [side for _, side in frame.groupby("node", sort=True)]
        made = sides[0][["first", "upto", "exit"]] if len(sides) == 1 else _composed(*sides, wait)
        return made.assign(__series=key[0], node=key[1])[["__series", "node", "first", "upto", "exit"]]

    pairs = steps.withColumn("pair", F.shiftright("node", 1))
    return pairs.groupBy("__series", "pair").applyInPandas(compose, _STEPS)


def _starts(level: DataFrame, above: DataFrame, wait: int) -> DataFrame:
    """When the quiet period before each node ends, from the same of the round above.

    A left neighbour starts as their pair does; a right one starts after the
    last fire of the left, or as the pair if that does not fire.
    """
    pair = above.select("__series", F.col("node").alias("__pair"), "free_at")
    nodes = level.select("__series", "node").distinct().withColumn("__pair", F.shiftright("node", 1))
    same = nodes.join(pair, ["__series", "__pair"]).drop("__pair")
    entered = F.col("free_at").isNull() | (F.col("upto") >= F.col("free_at"))
    fired = (
        level.filter("node % 2 = 0")
        .join(same, ["__series", "node"])
        .groupBy("__series", (F.col("node") + 1).alias("node"))
        .agg((F.min_by("exit", F.when(entered, F.col("upto"))) + wait).alias("__after"))
    )
    after = F.coalesce("__after", "free_at").alias("free_at")
    return same.join(fired, ["__series", "node"], "left").select("__series", "node", after)


def _range_starts(steps: DataFrame, wait: int) -> DataFrame:
    """When the quiet period before each node ends (NULL: none), for the functions of all ranges."""
    levels = [materialize(steps)]
    while levels[-1].filter("node > 0").head(1):
        levels.append(materialize(_compose_pairs(levels[-1], wait)))
    # Nothing comes before a whole series.
    starts = levels[-1].select("__series", "node", F.lit(None).cast("bigint").alias("free_at")).distinct()
    for level in reversed(levels[:-1]):
        starts = materialize(_starts(level, starts, wait))
    return starts


def cool_down(
    samples: DataFrame, key: str, limit: float = LIMIT, seconds: int = COOL_DOWN
) -> DataFrame:
    """Crossings that fire: per series, none within ``seconds`` after a fire.

    Exact for any distribution of samples over series. One range shuffle, one
    shuffle of the ranges into tasks, and the functions of ranges, composed in
    as many rounds as the logarithm of their number; a task holds two of them,
    each with a row at most for every crossing of one quiet period. There are
    as many ranges as ``ROWS_PER_RANGE`` asks for, so what a task holds at once
    does not grow with the table.
    """
    if seconds <= 0:
        return every_crossing(samples, limit).select(key, "event_id", "ts", "value")
    wait = seconds * 1_000_000
    kinds = dict(samples.dtypes)
    epoch = F.lit("1970-01-01").cast(kinds["ts"])
    # The series as text that is never NULL, so that rows without a series are one too.
    named = F.concat(F.lit("="), F.col(key).cast("string"))
    hits = every_crossing(samples, limit).select(
        key,
        "event_id",
        "ts",
        "value",
        F.coalesce(named, F.lit("")).alias("__series"),
        F.timestamp_diff("MICROSECOND", epoch, "ts").alias("__us"),
    )
    count = max(1, -(-hits.count() // ROWS_PER_RANGE))
    ranges = materialize(
        hits.repartitionByRange(count, "__series", "__us", "event_id").withColumn(
            "__range", F.spark_partition_id()
        )
    )

    def summarize(place: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for series, run in frame.groupby("__series", sort=True):
            times = np.sort(run["__us"].to_numpy())
            entry = np.searchsorted(times, times[0] + wait, side="left") + 1
            steps = _step_rows(times[0], times[:entry], _last_fire(times, wait)[:entry])
            rows.append(steps.assign(__series=series, node=place[0] - run["__lead"].iloc[0]))
        return pd.concat(rows)[["__series", "node", "first", "upto", "exit"]]

    def fire(frame: pd.DataFrame) -> pd.DataFrame:
        kept = []
        ordered = frame.sort_values(["__series", "__us", "event_id"], kind="stable")
        for series, run in ordered.groupby("__series", sort=True):
            own = run["__of"].iloc[0] == series
            kept.append(run[_fired(run["__us"].to_numpy(), wait, run["free_at"].iloc[0] if own else np.nan)])
        return pd.concat(kept)[[key, "event_id", "ts", "value"]]

    # A series that goes on from one range into the next is the last of the one
    # and the first of the other.
    edges = ranges.groupBy("__range").agg(F.min("__series").alias("lo"), F.max("__series").alias("hi"))
    spread = materialize(
        edges.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias("__series"), "__range")
        .groupBy("__series").agg(F.min("__range").alias("__lead"), F.max("__range").alias("__end"))
        .filter("__end > __lead")
    )
    parts = ranges.select("__series", "__us", "__range").join(spread, "__series")
    starts = _range_starts(parts.groupBy("__range").applyInPandas(summarize, _STEPS), wait)
    # Only the first series of a range can go on from before: one row a range at most.
    states = starts.filter("node > 0 and free_at is not null").join(spread, "__series").select(
        (F.col("__lead") + F.col("node")).cast("int").alias("__range"), F.col("__series").alias("__of"), "free_at"
    )
    fired_type = T.StructType([hits.schema[c] for c in (key, "event_id", "ts", "value")])
    started = ranges.join(states, "__range", "left")
    return started.groupBy("__range").applyInPandas(fire, fired_type)

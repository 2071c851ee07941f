"""Alert rules over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions.numbers import money
from tallyframe.operators import alerts
from tallyframe.queries.registry import Tables, query


@query("q_alert_every", "SELECT event_id, event_type, ts, value FROM events WHERE value > 75")
def alert_every(t: Tables):
    return alerts.every_crossing(t.events).select("event_id", "event_type", "ts", "value")


@query("q_alert_first", """
    SELECT event_type, MIN(ts) AS first_ts FROM events WHERE value > 75 GROUP BY event_type""")
def alert_first(t: Tables):
    return alerts.first_crossing(t.events, "event_type")


@query("q_alert_cool_down", """
    WITH RECURSIVE hits AS (
        SELECT event_type, event_id, ts, value,
               ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn
        FROM events WHERE value > 75),
    follow AS (
        SELECT *, MIN(rn) OVER (PARTITION BY event_type ORDER BY ts
                   RANGE BETWEEN INTERVAL 60 SECOND FOLLOWING AND UNBOUNDED FOLLOWING) AS next_rn
        FROM hits),
    fired AS (
        SELECT event_type, event_id, ts, value, next_rn FROM follow WHERE rn = 1
        UNION ALL
        SELECT n.event_type, n.event_id, n.ts, n.value, n.next_rn
        FROM fired f JOIN follow n ON n.event_type = f.event_type AND n.rn = f.next_rn)
    SELECT event_type, event_id, ts, value FROM fired""")
def alert_cool_down(t: Tables):
    return alerts.cool_down(t.events, "event_type")


@query("q_sample_window", """
    SELECT DATE_TRUNC('hour', ts) AS start, event_type,
           ROUND(AVG(CAST(value AS DECIMAL(18,2))), 6) AS mean, COUNT(*) AS samples
    FROM events GROUP BY DATE_TRUNC('hour', ts), event_type""")
def sample_window(t: Tables):
    """Values in exact hundredths, so a mean does not depend on the order they are added in."""
    samples = t.events.select("ts", "event_type", money(F.col("value")).alias("value"))
    return alerts.window_means(samples, "event_type", "1 hour")


_WIDTHS = ("10 minutes", "1 hour", "1 day")


@query("q_rolled_windows", " UNION ALL ".join(f"""
    SELECT '{w}' AS width, TIME_BUCKET(INTERVAL '{w}', ts) AS start, event_type,
           ROUND(AVG(CAST(value AS DECIMAL(18,2))), 6) AS mean, COUNT(*) AS samples
    FROM events GROUP BY ALL""" for w in _WIDTHS))
def rolled_windows(t: Tables):
    """Three widths from one scan; every fourth event is sent twice and counts once."""
    samples = t.events.select("event_id", "ts", "event_type", money(F.col("value")).alias("value"))
    sent = samples.union(samples.filter(F.col("event_id") % 4 == 0))
    rolled = alerts.rolled_means(sent, "event_type", _WIDTHS)
    found = [frame.select(F.lit(width).alias("width"), "*") for width, frame in rolled.items()]
    return found[0].union(found[1]).union(found[2])


@query("q_last20", """
    SELECT event_type, event_id, value FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) t
    WHERE rn <= 20""")
def last20(t: Tables):
    points = t.events.select("event_type", "event_id", "ts", "value")
    return alerts.last_points(points, "event_type").select("event_type", "event_id", "value")

"""Tables with a log: repeated, rival and dead writers; files rewritten only where rows change."""

import datetime as dt
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe import schemas
from tallyframe.operators import campaign
from tallyframe.sources import ledger

SCHEMA = schemas._table("case_id bigint, member_id bigint, triggered string, triggered_on date")


@pytest.fixture
def table(spark, tmp_path):
    return ledger.Table(spark, str(tmp_path / "table"), SCHEMA, ("case_id", "member_id"), buckets=4)


def pairs(spark, *spans, flag="N"):
    rows = [(c, c % 3 if c % 7 else None) for span in spans for c in range(*span)]
    df = spark.createDataFrame(rows, "case_id bigint, member_id bigint")
    return df.withColumns({"triggered": F.lit(flag), "triggered_on": F.lit(None).cast("date")})


def held(table):
    return sorted(((r.case_id, r.member_id) for r in ledger.read(table).collect()), key=str)


def keys(*spans):
    return sorted({(c, c % 3 if c % 7 else None) for span in spans for c in range(*span)}, key=str)


def test_filters_never_miss_and_seldom_err():
    rng = np.random.default_rng(1)
    own, others = rng.integers(-2**63, 2**63 - 1, 5000), rng.integers(-2**63, 2**63 - 1, 5000)
    bits = ledger.filter_bits(own)
    assert ledger.may_hold(bits, own).all() and ledger.may_hold(bits, others).mean() < 0.03
    assert not ledger.may_hold(ledger.filter_bits(own[:0]), others).any()


def test_each_run_once_and_each_key_once(spark, table):
    assert held(table) == []
    assert ledger.append_new(table, pairs(spark, (0, 60), (0, 20)), "a") == 60
    assert ledger.append_new(table, pairs(spark, (40, 100)), "b") == 40
    assert ledger.append_new(table, pairs(spark, (40, 100)), "b") == 0
    assert ledger.append_new(table, pairs(spark, (0, 100)), "c") == 0
    assert held(table) == keys((0, 100))
    assert [c.run_id for c in ledger.commits(table)] == ["a", "b", "c"]


def test_a_dead_writer_leaves_no_rows(spark, table):
    def dies():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        ledger.append_new(table, pairs(spark, (0, 50)), "a", pause=dies)
    assert held(table) == [] and len(list(ledger.unlisted_files(table))) == 1
    assert ledger.append_new(table, pairs(spark, (0, 50)), "a") == 50
    assert held(table) == keys((0, 50))


@pytest.mark.parametrize("second", ["b", "a"])
def test_a_writer_that_comes_in_between(spark, table, second):
    """The first has written its files when the second, or a retry of the first, commits."""
    ledger.append_new(table, pairs(spark, (0, 10)), "before")
    between = lambda: ledger.append_new(table, pairs(spark, (30, 80)), second)
    added = ledger.append_new(table, pairs(spark, (0, 50)), "a", pause=between)
    assert added == (20 if second == "b" else 0)
    assert held(table) == keys((0, 10), (30, 80), (0, 50) if second == "b" else (0, 10))


def test_writers_side_by_side(spark, table):
    """All write their files before any commits; every key is there once."""
    gate, added = threading.Barrier(3), {}

    def write(run, span):
        added[run] = ledger.append_new(table, pairs(spark, span), run, pause=lambda: gate.wait(120))

    threads = [threading.Thread(target=write, args=(run, span)) for run, span in (("a", (0, 40)), ("b", (20, 60)), ("c", (50, 70)))]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert held(table) == keys((0, 70)) and sum(added.values()) == 70


def test_only_candidate_files_are_read(spark, table):
    for k in range(5):
        ledger.append_new(table, pairs(spark, (k * 100, k * 100 + 100)), f"run-{k}")
    entries = ledger.commits(table)
    live = ledger.live_files(entries)
    found = ledger.candidate_files(table, pairs(spark, (205, 206)), entries, live)
    own = set(entries[2].added)
    assert len(live) == 20 and len(own & set(found)) == 1 and len(found) <= 4
    assert ledger.candidate_files(table, pairs(spark, (0, 0)), entries, live) == []


def test_flags_rewrite_only_files_with_hits(spark, tmp_path):
    table = ledger.Table(spark, str(tmp_path / "flags"), SCHEMA, ("case_id",), buckets=8)
    ledger.append_new(table, pairs(spark, (0, 400)), "a")
    before = {name: r for name in ledger.live_files(ledger.commits(table)) for r in [ledger.read(table, [name]).count()]}
    sent = spark.createDataFrame([(7,), (7,), (11,), (9999,)], "case_id bigint")
    gone, stayed = campaign.mark_triggered_in(table, sent, dt.date(2026, 10, 1), "mark")
    after = ledger.live_files(ledger.commits(table))
    assert 1 <= gone <= 2 and stayed == len(before) - gone and len(set(before) & set(after)) == stayed
    rows = {r.case_id: (r.triggered, r.triggered_on) for r in ledger.read(table).collect()}
    assert len(rows) == 400 == ledger.read(table).count()
    assert {k for k, v in rows.items() if v == ("Y", dt.date(2026, 10, 1))} == {7, 11}
    # The same run, or another for rows that are flagged, writes nothing.
    for run in ("mark", "again"):
        assert campaign.mark_triggered_in(table, sent, dt.date(2030, 1, 1), run)[0] == 0
    assert ledger.live_files(ledger.commits(table)) == after


def test_flags_after_a_rival_append(spark, tmp_path):
    table = ledger.Table(spark, str(tmp_path / "both"), SCHEMA, ("case_id",), buckets=2)
    ledger.append_new(table, pairs(spark, (0, 20)), "a")
    rival = []

    def change(rows):
        if not rival:
            rival.append(ledger.append_new(table, pairs(spark, (20, 30)), "b"))
        return campaign.mark_triggered(rows, hits, F.lit(dt.date(2026, 10, 1)))

    hits = spark.createDataFrame([(3,), (25,)], "case_id bigint")
    ledger.update(table, hits, change, "mark", "coalesce(triggered, 'N') = 'N'")
    rows = {r.case_id: r.triggered for r in ledger.read(table).collect()}
    assert len(rows) == 30 and {k for k, v in rows.items() if v == "Y"} == {3, 25}

"""Batches, requests, notes, flags and text limits."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyframe import schemas
from tallyframe.functions.text import next_code
from tallyframe.operators import campaign
from tallyframe.sources.files import from_rows

RUN = dt.datetime(2026, 10, 1, 9, 0)
MESSAGE = campaign.MessageTemplate("test", {"en": "hello", "pt": "olá", "es": "¡hola!"})


@pytest.mark.parametrize("total,shares", [
    (0, [0, 0, 0, 0, 0]), (1, [1, 0, 0, 0, 0]), (4, [4, 0, 0, 0, 0]), (5, [1] * 5),
    (7, [1, 1, 1, 1, 3]), (12, [2, 2, 2, 2, 4]),
])
def test_five_runs_cover_every_case_once(spark, total, shares):
    schema = schemas._table("case_id bigint, triggered string")
    state = {n: None for n in range(1, total + 1)}
    seen = []
    for want in shares:
        # Two rows per case: a case is counted once.
        rows = [(n, f) for n, f in state.items() for _ in range(2)]
        picked = sorted(r.case_id for r in campaign.pick_batch(from_rows(spark, rows, schema)).collect())
        assert len(picked) == want
        seen += picked
        for n in picked:
            state[n] = "Y"
    assert seen == sorted(state)


def test_large_batch_is_the_first_fifth(spark):
    df = spark.range(1, 1501).select(F.col("id").alias("case_id"), F.lit("N").alias("triggered"))
    assert [r.case_id for r in campaign.pick_batch(df).orderBy("case_id").collect()] == list(range(1, 301))


@pytest.mark.parametrize("code,following", [
    ("SMS0001", "SMS0002"), ("SMS0099", "SMS0100"), ("SMS1010", "SMS1011"), ("SMS9999", "SMS10000"),
])
def test_next_code(spark, code, following):
    df = spark.createDataFrame([(code,)], "code string")
    assert df.select(next_code(F.col("code"))).first()[0] == following


def templates(spark, tag="old"):
    return from_rows(
        spark, [("SMS0099", "d", "a", "b", "c", 1, 1, 1, RUN.date(), None, tag)], schemas.TEMPLATES
    )


def test_codes_go_on_after_a_carry(spark):
    codes = spark.createDataFrame([("SMS99",), ("SMS100",), ("SMS7",)], "code string")
    assert codes.agg(next_code(campaign.latest_code("code"))).first()[0] == "SMS101"
    empty = templates(spark).limit(0)
    assert campaign.template_row(empty, MESSAGE, RUN.date(), "new", "SMS01").first().code == "SMS01"


def test_template_row_is_written_once(spark):
    row = campaign.template_row(templates(spark), MESSAGE, RUN.date(), "new").first()
    assert (row.code, row.len_en, row.len_pt, row.len_es) == ("SMS0100", 5, 3, 6)
    assert campaign.template_row(templates(spark, "new"), MESSAGE, RUN.date(), "new").count() == 0


def test_template_dates_once(spark):
    children = spark.createDataFrame([], "code string")
    got = campaign.template_dates(templates(spark), children, RUN.date(), "old")
    assert [(r.code, r.archive_dt) for r in got.collect()] == [("SMS0099", dt.date(2999, 12, 31))]
    assert campaign.template_dates(templates(spark), got, RUN.date(), "old").count() == 0


def test_requests_and_ids_after_the_highest(spark):
    batch = spark.createDataFrame([(3,), (1,), (3,)], "case_id bigint")
    old = from_rows(spark, [], schemas.REQUESTS)
    first = campaign.message_requests(
        batch, "SMS0001", RUN.date(), RUN, "t", campaign.next_id(old, "request_id"))
    assert [(r.request_id, r.case_id) for r in first.orderBy("request_id").collect()] == [
        (1, "1"), (2, "3")]
    assert set(first.columns) == set(schemas.REQUESTS.names)
    more = campaign.message_requests(
        batch, "SMS0001", RUN.date(), RUN, "t", campaign.next_id(first, "request_id"))
    assert sorted(r.request_id for r in more.collect()) == [3, 4]


NOTICE = campaign.NoticeTemplate(
    {"en": "a", "pt": "b", "es": "c"},
    {"en": "by [DUE_DATE]\n", "pt": "até [DUE_DATE]", "es": "antes [DUE_DATE] [X]"},
)


def test_notice_requests(spark):
    rows = [(1, "N"), (2, None), (2, None), (3, "Y")]
    people = spark.createDataFrame(rows, "case_id bigint, notice_triggered string")
    got = campaign.notice_requests(people, NOTICE, RUN, "n").orderBy("request_id").collect()
    assert [(r.case_list, r.text_en) for r in got] == [
        ("1", "by 16-OCT-2026\n"), ("2", "by 16-OCT-2026\n")]
    assert got[0].text_pt == "até 16-OCT-2026"
    assert set(got[0].asDict()) == set(schemas.NOTICE_REQUESTS.names)


def test_notes_once(spark):
    one = lambda *ids: spark.createDataFrame([(i,) for i in ids], "case_id bigint")
    notes = from_rows(spark, [], schemas.NOTES)
    first = campaign.case_notes(one(1, 2, 2, 9), one(1, 2, 3), notes, "t", RUN.date(), "n")
    assert sorted(r.case_id for r in first.collect()) == [1, 2]
    assert set(first.columns) == set(schemas.NOTES.names)
    assert campaign.case_notes(one(1, 2), one(1, 2), first, "t", RUN.date(), "n").count() == 0
    assert campaign.case_notes(one(1), one(1), first, "t", RUN.date(), "other").count() == 1


def requests(spark, *texts, tag="t"):
    rows = [(n, text, "c", "N", RUN.date(), "S", "M", n, tag, RUN, n, RUN.date())
            for n, text in enumerate(texts)]
    return from_rows(spark, rows, schemas.REQUESTS)


def test_flags(spark):
    old = dt.date(2020, 1, 1)
    target = spark.createDataFrame(
        [(1, "N", None), (2, None, None), (3, "Y", old), (4, "N", None), (5, "N", old)],
        "case_id bigint, triggered string, triggered_on date",
    )
    sent = campaign.requested_cases(requests(spark, "1", "2", "3", "5", "5", "1,4", "x"), "t")
    got = campaign.mark_triggered(target, sent, F.lit(RUN.date()))
    assert {r.case_id: (r.triggered, r.triggered_on) for r in got.collect()} == {
        1: ("Y", RUN.date()), 2: ("Y", RUN.date()), 3: ("Y", old), 4: ("N", None),
        5: ("Y", RUN.date()),
    }
    dated = campaign.mark_triggered(target, sent, F.lit(RUN.date()), only_undated=True)
    assert {r.case_id: r.triggered for r in dated.collect()}[5] == "N"
    again = campaign.mark_triggered(got, sent, F.lit(dt.date(2030, 1, 1)))
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))


def test_request_lists_and_times(spark):
    written = requests(spark, "1,4", "2")
    ids = lambda df: sorted(r.case_id for r in df.collect())
    assert ids(campaign.requested_cases(written, "t")) == [2]
    assert ids(campaign.requested_cases(written, "t", split_lists=True)) == [1, 2, 4]
    assert ids(campaign.requested_cases(written, "u")) == []
    assert ids(campaign.requested_cases(written, "t", since=RUN + dt.timedelta(days=1))) == []


def test_text_limits(spark):
    texts = ["x" * 3500, "x" * 3501, "x" * 4000, "x" * 4001, "é" * 4000, None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    over = campaign.over_limit(df, 4000, "body")
    assert sorted(r.id for r in over.collect()) == [3, 4]
    assert over.first().over_columns == ["body"]
    cut = {r.id: (r.body, r.truncated) for r in campaign.cap_texts(df, 3500, "body").collect()}
    assert cut[0] == ("x" * 3500, False) and cut[1] == ("x" * 3500, True)
    assert cut[4] == ("é" * 3500, True) and cut[5] == (None, False)
    fine = campaign.fail_if_over(df.filter("id <= 2"), 4000, "body")
    assert fine.count() == 3 and fine.collect()[2].body == "x" * 4000
    with pytest.raises(Exception, match="body is above 4000 bytes"):
        campaign.fail_if_over(df, 4000, "body").collect()


def test_swap_column(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    got = campaign.swap_column(df, "b", "string")
    assert got.dtypes == [("a", "int"), ("b", "string"), ("c", "int")]
    assert got.first().b == "2"


def test_run_once(spark):
    rows = spark.createDataFrame([(1,)], "x int")
    assert campaign.once_per_tag(rows, templates(spark), "new").count() == 1
    assert campaign.once_per_tag(rows, templates(spark), "old").count() == 0


def test_counts_per_step(spark, tmp_path):
    a, seen_a = campaign.counted(spark.range(7), "a")
    b, seen_b = campaign.counted(spark.range(9).filter("id > 2"), "b")
    a.write.parquet(str(tmp_path / "a"))
    b.write.parquet(str(tmp_path / "b"))
    assert campaign.run_report([seen_a, seen_b], ["first", "second"]) == {"first": 7, "second": 6}

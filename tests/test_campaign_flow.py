"""The message campaign from population to sent flags, five runs over one set of tables."""

import datetime as dt

from pyspark.sql import functions as F

from tallyframe import schemas
from tallyframe.operators import campaign, population as pop
from tallyframe.sources import catalog, files
from test_population import AS_OF, rules, tables  # noqa: F401  (fixture)

MESSAGE = campaign.MessageTemplate("plan change", {"en": "a", "pt": "b", "es": "c"})
TAG = "campaign-7"


def test_five_runs(spark, tables, tmp_path):  # noqa: F811
    names = {"flow_population": schemas.POPULATION, "flow_contacts": schemas.CONTACTS,
             "flow_templates": schemas.TEMPLATES, "flow_requests": schemas.REQUESTS}
    for name, schema in names.items():
        catalog.drop_if_present(spark, name)
        catalog.create_if_absent(spark, name, schema)
    seed = [("SMS0041", "old", "x", "y", "z", 1, 1, 1, AS_OF, None, "someone")]
    catalog.append_by_name(files.from_rows(spark, seed, schemas.TEMPLATES), "flow_templates")

    # Population and contacts, each run twice: the second adds nothing.
    people = pop.impacted_population(tables, rules())
    rows = people.select("case_id", "member_id", "assistance_cd").withColumn(
        "inserted_at", F.lit("2026-10-01 08:00:00").cast("timestamp"))
    added = [campaign.append_new(rows, "flow_population", "case_id", "member_id") for _ in range(2)]
    assert added[0] == people.count() > 5 and added[1] == 0

    types = files.from_rows(spark, [("C", "Cell")], schemas.CODE_LOOKUP)
    reps = files.from_rows(spark, [], schemas.REPRESENTATIVES)
    contacts = pop.contact_list(
        spark.table("flow_population"), tables.cases, tables.phone_xref, tables.phones, reps,
        types, AS_OF, AS_OF)
    assert campaign.append_new(contacts, "flow_contacts", "case_id") == added[0]
    assert campaign.append_new(contacts, "flow_contacts", "case_id") == 0

    # The template once.
    for want in (1, 0):
        row = campaign.template_row(spark.table("flow_templates"), MESSAGE, AS_OF, TAG)
        assert row.count() == want
        catalog.append_by_name(row, "flow_templates")
    code = spark.table("flow_templates").filter(F.col("created_by") == TAG).agg(
        F.max("code").alias("code"))

    state = spark.table("flow_contacts")
    sizes = []
    for run in range(5):
        day = AS_OF + dt.timedelta(days=run)
        batch = campaign.pick_batch(state)
        requests = campaign.message_requests(
            batch, code.scalar(), day, dt.datetime(day.year, day.month, day.day, 9), TAG,
            campaign.next_id(spark.table("flow_requests"), "request_id"))
        catalog.append_by_name(requests, "flow_requests")
        sent = campaign.requested_cases(spark.table("flow_requests"), TAG)
        marked = campaign.mark_triggered(state, sent, F.lit(day))
        state = files.write_snapshot(marked, str(tmp_path / f"contacts-{run}"))
        sizes.append(state.filter(F.col("triggered_on") == day).count())

    total = added[0]
    assert sizes == [total // 5] * 4 + [total - 4 * (total // 5)]
    written = spark.table("flow_requests")
    assert written.count() == written.select("case_id").distinct().count() == total
    ids = sorted(r.request_id for r in written.collect())
    assert ids == list(range(1, total + 1))
    assert {r.template_code for r in written.collect()} == {"SMS0042"}
    assert state.filter("triggered = 'Y'").count() == total
    assert campaign.pick_batch(state).count() == 0
    for name in names:
        catalog.drop_if_present(spark, name)


NOTICE = campaign.NoticeTemplate(
    {"en": "Change", "pt": "Mudança", "es": "Cambio"},
    {"en": "Reply by [DUE_DATE].\n", "pt": "Responda até [DUE_DATE].\r", "es": "Responda antes del [DUE_DATE]."},
)


def test_notice_run(spark, tables, tmp_path):  # noqa: F811
    names = {"note_population": schemas.NOTICE_POPULATION, "note_info": schemas.TRIGGER_INFO,
             "note_requests": schemas.NOTICE_REQUESTS, "note_notes": schemas.NOTES}
    for name, schema in names.items():
        catalog.drop_if_present(spark, name)
        catalog.create_if_absent(spark, name, schema)
    run = dt.datetime(2026, 10, 1, 9)

    people = pop.impacted_population(tables, rules(contact=False)).select(
        "case_id", "member_id", "assistance_cd")
    info = people.withColumns({f"{k}_triggered": F.lit("N") for k in ("notice", "sms", "email")})
    keys = ("case_id", "member_id")
    for _ in range(2):
        campaign.append_new(info, "note_info", *keys)
        campaign.append_new(info.select(*keys, "assistance_cd", "notice_triggered"),
                            "note_population", *keys)
    total = people.count()
    assert spark.table("note_info").count() == spark.table("note_population").count() == total

    # One request per case, refused if a letter is over the limit; then the notes.
    steps = []
    requests = campaign.fail_if_over(
        campaign.notice_requests(spark.table("note_population"), NOTICE, run, TAG),
        4000, "text_en", "text_pt", "text_es")
    rows, seen = campaign.counted(requests, "requests")
    catalog.append_by_name(rows, "note_requests")
    steps.append(seen)
    for want in (total, 0):
        notes = campaign.case_notes(
            spark.table("note_population"), tables.cases, spark.table("note_notes"), "sent",
            run.date(), TAG, first_id=campaign.next_id(spark.table("note_notes"), "note_id"))
        rows, seen = campaign.counted(notes, "notes")
        catalog.append_by_name(rows, "note_notes")
        assert seen.get["rows"] == want
        steps.append(seen)
    assert campaign.run_report(steps, ["requests", "notes", "notes again"]) == {
        "requests": total, "notes": total, "notes again": 0}
    letter = spark.table("note_requests").first()
    assert letter.text_pt == "Responda até 16-OCT-2026.\r" and letter.processed == "N"

    # Requests of the last day flag both tables; nothing is left for another run.
    sent = campaign.requested_cases(
        spark.table("note_requests"), TAG, since=dt.datetime(2026, 9, 30), column="case_list")
    for name in ("note_population", "note_info"):
        marked = campaign.mark_triggered(
            spark.table(name), sent, F.lit("2026-10-01 09:30:00").cast("timestamp"),
            "notice_triggered", "notice_triggered_dt", only_undated=True)
        after = files.write_snapshot(marked, str(tmp_path / name))
        assert after.schema.names == names[name].names
        assert after.filter("notice_triggered = 'Y' and notice_triggered_dt is not null").count() == total
        assert campaign.notice_requests(after, NOTICE, run, TAG).count() == 0
    for name in names:
        catalog.drop_if_present(spark, name)

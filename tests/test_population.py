"""One invented row for every reason to be kept or dropped."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyframe import schemas
from tallyframe.functions.dates import add_months_eom, whole_years
from tallyframe.operators import campaign, population as pop
from tallyframe.plans.hold import held, keep
from tallyframe.plans.inspect import plan_text
from tallyframe.sources.files import from_rows

AS_OF = dt.date(2026, 10, 1)
D = dt.date

BASE = dict(
    pref="Y", assistance="T1", program="P", run=D(2026, 1, 1), status="AP", current="A",
    closed=None, target="Y", birth=D(1990, 5, 5), citizen=None, demo_end=None,
    codes=[(1, "Z")], spans=[], phones=[("CS", "C", "Y")], delete="N",
)

# name -> (changes to the plain adult, in contact form, in notice form)
PEOPLE = {
    "plain": ({}, True, True),
    "latest listed": ({"codes": [(1, "Z"), (2, "A")]}, False, False),
    "older listed": ({"codes": [(1, "A"), (2, "Z")]}, True, True),
    "null code not citizen": ({"codes": [(1, None)], "citizen": "N"}, True, True),
    "null code citizen": ({"codes": [(1, None)], "citizen": "Y"}, False, False),
    "null code no demographics": ({"codes": [(1, None)]}, False, False),
    "null code closed demographics": (
        {"codes": [(1, None)], "citizen": "N", "demo_end": D(2020, 1, 1)}, False, False),
    "no external row": ({"codes": []}, False, False),
    "open span, due later": ({"spans": [(D(2026, 1, 1), None, None, D(2026, 12, 1))]}, False, False),
    "span begun on the day": ({"spans": [(AS_OF, None, None, D(2026, 12, 1))]}, True, True),
    "span ended on the day": (
        {"spans": [(D(2026, 1, 1), AS_OF, None, D(2026, 12, 1))]}, True, True),
    "event ended 12 months before": (
        {"spans": [(D(2025, 1, 1), D(2025, 10, 1), D(2025, 10, 1), None)]}, False, False),
    "event ended a day more before": (
        {"spans": [(D(2025, 1, 1), D(2025, 9, 30), D(2025, 9, 30), None)]}, True, True),
    "event ended on the day": (
        {"spans": [(D(2026, 1, 1), AS_OF, AS_OF, None)]}, False, False),
    "age 20": ({"birth": D(2006, 10, 1)}, True, True),
    "age 19": ({"birth": D(2006, 10, 2)}, False, False),
    "payment closed": ({"closed": D(2026, 2, 1)}, False, False),
    "not approved": ({"status": "DN"}, False, False),
    "not current": ({"current": "I"}, False, False),
    "other assistance": ({"assistance": "T2"}, False, False),
    "not targeted": ({"target": "N"}, False, False),
    "pref null": ({"pref": None}, True, True),
    "pref empty": ({"pref": ""}, True, True),
    "pref blank": ({"pref": " "}, True, True),
    "pref no": ({"pref": "N"}, False, True),
    "phone not verified": ({"phones": [("CS", "C", "N")]}, False, True),
    "phone other type": ({"phones": [("CS", "H", "Y")]}, False, True),
    "phone other source": ({"phones": [("IN", "C", "Y")]}, False, True),
    "no phone": ({"phones": []}, False, True),
    "two traces": ({"traces": 2}, True, True),
}
IDS = {name: n for n, name in enumerate(PEOPLE, start=1)}


@pytest.fixture(scope="module")
def tables(spark):
    rows = {k: [] for k in ("cases", "elig", "member", "people", "demo", "spans", "ext", "xref",
                            "phones")}
    phone = 1000
    for name, (change, _, _) in PEOPLE.items():
        n, p = IDS[name], {**BASE, **change}
        key = f"K{n}"
        rows["cases"].append((n, p["pref"], "EN"))
        for trace in range(p.get("traces", 1)):
            rows["elig"].append((n, 10 * n + trace, p["assistance"], p["program"],
                                 p["run"] + dt.timedelta(trace), p["status"], p["current"],
                                 p["closed"], p["delete"]))
            rows["member"].append((n, 10 * n + trace, n, p["target"]))
        rows["people"].append((n, key, p["birth"]))
        if p["citizen"]:
            rows["demo"].append((n, p["citizen"], p["demo_end"]))
        rows["spans"] += [(n, *s) for s in p["spans"]]
        rows["ext"] += [(key, code, seq) for seq, code in p["codes"]]
        for source, kind, ok in p["phones"]:
            phone += 1
            rows["xref"].append((phone, n, source))
            rows["phones"].append((phone, f"555-{phone}", kind, ok))
    # Flags: a line of "plain" in its own case; another of "age 20" in a case it has no base line in.
    plain, other = IDS["plain"], IDS["age 20"]
    rows["elig"] += [(plain, 900, "FA", "P", D(2026, 1, 1), "CE", "A", None, "N"),
                     (500, 901, "FA", "P", D(2026, 1, 1), "AP", "A", None, "N"),
                     (plain, 902, "X", "FB", D(2026, 1, 1), "AP", "A", None, "Y")]
    rows["member"] += [(plain, 900, plain, "Y"), (500, 901, other, "Y"), (plain, 902, plain, "Y")]
    make = lambda name, schema: from_rows(spark, rows[name], schema)
    return pop.PopulationTables(
        cases=make("cases", schemas.CASES),
        eligibility=make("elig", schemas.ELIGIBILITY),
        member_eligibility=make("member", schemas.MEMBER_ELIGIBILITY),
        members=make("people", schemas.MEMBERS),
        demographics=make("demo", schemas.DEMOGRAPHICS),
        exclusion_spans=make("spans", schemas.EXCLUSION_SPANS),
        external_status=make("ext", schemas.EXTERNAL_STATUS),
        phone_xref=make("xref", schemas.PHONE_XREF),
        phones=make("phones", schemas.PHONES),
        languages=from_rows(spark, [("EN", "English")], schemas.CODE_LOOKUP),
    )


def rules(contact=True):
    return pop.PopulationRules(
        as_of=AS_OF, assistance_cd="T1", excluded_codes=("A", "B"), require_contact=contact,
        flags={"flag_a": F.col("assistance_cd") == "FA", "flag_b": F.col("program_cd") == "FB"},
    )


@pytest.mark.parametrize("contact", [True, False])
def test_each_reason(tables, contact):
    got = [r.case_id for r in pop.impacted_population(tables, rules(contact)).collect()]
    want = [IDS[n] for n, (_, a, b) in PEOPLE.items() if (a if contact else b)]
    assert sorted(got) == sorted(want)


def test_flags_language_and_columns(tables):
    rows = {r.case_id: r for r in pop.impacted_population(tables, rules()).collect()}
    assert (rows[IDS["plain"]].flag_a, rows[IDS["plain"]].flag_b) == ("Y", "N")
    assert rows[IDS["age 20"]].flag_a == "N"
    assert rows[IDS["plain"]].language == "English" and rows[IDS["plain"]].assistance_cd == "T1"


def test_persisted_base_gives_the_same(tables):
    with held(pop.base_pairs(tables, rules())) as base:
        kept = pop.impacted_population(tables, rules(), hold=lambda _: base)
        assert plan_text(kept).count("InMemoryRelation") >= 1
        want = pop.impacted_population(tables, rules())
        assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, want.collect()))
    assert keep(base).storageLevel.useDisk
    base.unpersist()


def test_excluded_is_the_union_of_both_lists(tables):
    spans = tables.exclusion_spans
    union = pop.active_spans(spans, AS_OF).select("member_id").union(
        pop.recent_spans(spans, AS_OF).select("member_id")).distinct()
    assert sorted(union.collect()) == sorted(pop.excluded_members(spans, AS_OF).collect())


def test_birth_date_limit_equals_whole_years(spark):
    """The limit the scan gets and the age in years agree around every birthday."""
    both = spark.sql("""
        select a, explode(sequence(date_sub(add_months(a, -240), 3),
                                   date_add(add_months(a, -240), 3))) as b
        from (select explode(sequence(date'2023-01-01', date'2028-12-31', interval 1 day)) as a)
    """)
    by_years = whole_years(F.col("b"), F.col("a")) >= 20
    by_limit = F.col("b") <= add_months_eom(F.col("a"), -240)
    assert both.filter(by_years != by_limit).count() == 0


def test_append_adds_nothing_the_second_time(tables):
    rows = pop.impacted_population(tables, rules()).select("case_id", "member_id").distinct()
    first = campaign.new_rows(rows, rows.limit(0), "case_id", "member_id")
    target = first.filter(F.col("case_id") != IDS["plain"])
    again = campaign.new_rows(rows, target, "case_id", "member_id")
    assert [r.case_id for r in again.collect()] == [IDS["plain"]]
    assert campaign.new_rows(rows, first, "case_id", "member_id").count() == 0


def test_contacts(spark):
    cases = from_rows(spark, [(1, "Y", "EN"), (2, " y", "EN"), (3, None, "EN"), (4, " ", "EN"),
                              (5, "Y", "EN"), (6, "Y", "EN")], schemas.CASES)
    population = from_rows(spark, [(n,) for n in (1, 2, 3, 4, 5, 1)],
                           schemas._table("case_id bigint"))
    xref = from_rows(spark, [(10, 1, "CS"), (11, 1, "CS"), (12, 3, "CS"), (13, 4, "CS"),
                             (14, 2, "CS"), (15, 6, "CS"), (16, 4, "CS")], schemas.PHONE_XREF)
    phones = from_rows(spark, [(n, f"N{n}", "C", "Y") for n in (10, 11, 12, 13, 14, 15, 16)],
                       schemas.PHONES)
    reps = from_rows(spark, [
        (4, "R1", "C", "e", "m", "S", None), (4, "R2", "C", "e", "m", "S", D(2027, 1, 1)),
        (4, "R2", "C", "f", "m", "S", None), (3, "R3", "C", "e", "m", "S", D(2026, 1, 1)),
        (1, "R4", "C", "e", "m", "X", None),
    ], schemas.REPRESENTATIVES)
    types = from_rows(spark, [("C", "Cell")], schemas.CODE_LOOKUP)
    got = pop.contact_list(population, cases, xref, phones, reps, types, AS_OF, AS_OF).collect()
    assert sorted((r.case_id, r.phone, r.opt_in, r.rep_available) for r in got) == [
        (1, "N10", "Y", "N"), (1, "N11", "Y", "N"), (3, "N12", "N", "N"),
        (4, "R1", "N", "Y"), (4, "R2", "N", "Y"),
    ]
    assert {r.phone_type for r in got} == {"Cell"}

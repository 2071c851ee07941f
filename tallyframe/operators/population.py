"""Selecting the people a rule change affects, and whom to contact about it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions.dates import add_months_eom, span_covers, within_months_before
from tallyframe.functions.text import flag_or_no, yes_or_unset
from tallyframe.operators.joins import left_join_many
from tallyframe.operators.ranking import newest
from tallyframe.plans.lineage import materialize


@dataclass(frozen=True)
class PopulationTables:
    cases: DataFrame
    eligibility: DataFrame
    member_eligibility: DataFrame
    members: DataFrame
    demographics: DataFrame
    exclusion_spans: DataFrame
    external_status: DataFrame
    phone_xref: DataFrame | None = None
    phones: DataFrame | None = None
    languages: DataFrame | None = None


@dataclass(frozen=True)
class PopulationRules:
    """Which rows count. The defaults are fixed code values of the source tables."""

    as_of: dt.date
    assistance_cd: str
    excluded_codes: Sequence[str]
    approved: str = "AP"
    flag_statuses: Sequence[str] = ("AP", "CE")
    current: str = "A"
    min_age: int = 20
    lookback_months: int = 12
    require_contact: bool = True
    # Columns that tie a member row to its eligibility line; the trace alone
    # where it is unique over cases.
    line_keys: Sequence[str] = ("case_id", "trace_id")
    # Further condition on a base line, over eligibility and member columns.
    base_filter: Column | None = None
    # Flag name -> condition over eligibility columns; 'Y' if any of a member's lines meets it.
    flags: Mapping[str, Column] = field(default_factory=dict)


# --- exclusion spans -------------------------------------------------------


def _is_active(day: dt.date) -> Column:
    # The later of both dates; ``greatest`` passes over a missing one.
    runs_on = F.greatest("event_end_dt", "due_dt") >= F.lit(day)
    return span_covers(F.col("eff_begin_dt"), F.col("eff_end_dt"), day) & F.coalesce(runs_on, F.lit(False))


def _is_recent(day: dt.date, months: int) -> Column:
    return within_months_before(F.coalesce("event_end_dt", "due_dt"), day, months)


def active_spans(spans: DataFrame, day: dt.date) -> DataFrame:
    """Spans running on ``day`` whose event has not ended or whose due date is still to come."""
    return spans.filter(_is_active(day))


def recent_spans(spans: DataFrame, day: dt.date, months: int = 12) -> DataFrame:
    """Spans whose event ended, or was due, within the months up to ``day``."""
    return spans.filter(_is_recent(day, months))


def excluded_members(spans: DataFrame, day: dt.date, months: int = 12) -> DataFrame:
    """Distinct members with an active or a recent span.

    Equal to the distinct union of the two lists, in one scan and one shuffle.
    """
    hit = _is_active(day) | _is_recent(day, months)
    return spans.filter(hit).select("member_id").distinct()


# --- status and contact ----------------------------------------------------


def latest_status(
    external: DataFrame, excluded_codes: Sequence[str], people: DataFrame | None = None
) -> DataFrame:
    """Latest external row per person, kept unless its code is listed.

    The code is tested after the latest row is found: a person whose latest
    code is listed drops out, whatever older rows say. With ``people`` (a
    ``person_key`` column) only their rows are ranked.
    """
    if people is not None:
        external = external.join(people.select("person_key").distinct(), "person_key", "left_semi")
    latest = newest(external, ["person_key"], [F.col("seq_num").desc()])
    code = F.col("status_cd")
    return latest.filter(~code.isin(list(excluded_codes)) | code.isNull()).select(
        "person_key", F.col("status_cd").alias("code")
    )


def verified_phones(phone_xref: DataFrame, phones: DataFrame) -> DataFrame:
    """Distinct verified contact numbers per case."""
    on_case = phone_xref.filter(F.col("source_type") == "CS").select(
        "phone_seq", F.col("source_id").alias("case_id")
    )
    verified = phones.filter((F.col("verified_sw") == "Y") & (F.col("type_cd") == "C")).select(
        "phone_seq", "number", "type_cd"
    )
    return on_case.join(verified, "phone_seq").select("case_id", "number", "type_cd").distinct()


def _asked_cases(cases: DataFrame) -> DataFrame:
    return cases.filter(yes_or_unset(F.col("sms_pref")))


# --- the population --------------------------------------------------------


def _member_lines(tables: PopulationTables, rules: PopulationRules) -> DataFrame:
    """Current, open lines of targeted members that count as base or for a flag."""
    for_flags = F.col("status_cd").isin(list(rules.flag_statuses)) & (F.col("delete_sw") == "N")
    marks = {name: for_flags & test for name, test in rules.flags.items()}
    base = (F.col("assistance_cd") == rules.assistance_cd) & (F.col("status_cd") == rules.approved)
    lines = (
        tables.eligibility.filter(
            (F.col("current_ind") == rules.current) & F.col("payment_end_dt").isNull()
        )
        .filter(reduce(or_, marks.values(), base))
        .withColumn("is_base", base)
        .withColumns({name: F.coalesce(mark, F.lit(False)) for name, mark in marks.items()})
    )
    targeted = tables.member_eligibility.filter(F.col("target_sw") == "Y")
    joined = lines.join(targeted, list(rules.line_keys))
    if rules.base_filter is not None:
        joined = joined.withColumn("is_base", F.col("is_base") & rules.base_filter)
    return joined


def base_pairs(tables: PopulationTables, rules: PopulationRules) -> DataFrame:
    """One row per (case, member) with a base line, with the pair's own flags.

    Base and flag conditions are read from the same joined lines, which are
    summed up per pair before any further join. So the two large tables are
    joined once, and the pair rows are what the later joins move.
    """
    lines = _member_lines(tables, rules)
    pairs = lines.groupBy("case_id", "member_id").agg(
        F.max("is_base").alias("is_base"), *[F.max(name).alias(name) for name in rules.flags]
    )
    base = pairs.filter("is_base").drop("is_base")
    cases = tables.cases
    if rules.require_contact:
        cases = _asked_cases(cases).join(
            verified_phones(tables.phone_xref, tables.phones).select("case_id").distinct(),
            "case_id", "left_semi",
        )
    excluded = excluded_members(tables.exclusion_spans, rules.as_of, rules.lookback_months)
    return (
        base.join(cases.select("case_id", "read_lang"), "case_id")
        .join(excluded, "member_id", "left_anti")
    )


def eligible_people(
    tables: PopulationTables, rules: PopulationRules, wanted: DataFrame | None = None
) -> DataFrame:
    """One row per member of age whose latest status passes.

    With ``wanted`` (a ``member_id`` column) only these members, and only their
    status rows, are looked at.

    Age is tested against a birth date limit, a constant the scan can use,
    which is the same as comparing whole years. A person without a status code
    passes only with an open demographics row that says not a citizen.
    """
    born_by = add_months_eom(F.lit(rules.as_of), -12 * rules.min_age)
    of_age = tables.members.filter(F.col("birth_dt") <= born_by).select("member_id", "person_key")
    if wanted is not None:
        of_age = of_age.join(wanted.select("member_id").distinct(), "member_id", "left_semi")
    foreign = (
        tables.demographics.filter(F.col("eff_end_dt").isNull() & (F.col("citizen_sw") == "N"))
        .select("member_id").distinct().withColumn("not_citizen", F.lit(True))
    )
    people = (
        of_age.join(latest_status(tables.external_status, rules.excluded_codes, of_age), "person_key")
        .join(foreign, "member_id", "left")
    )
    return people.filter(F.col("code").isNotNull() | F.col("not_citizen")).select(
        "member_id", "code"
    )


def impacted_population(
    tables: PopulationTables,
    rules: PopulationRules,
    hold: Callable[[DataFrame], DataFrame] = materialize,
) -> DataFrame:
    """Distinct (case, member) pairs the rules select, with code, flags and language.

    The base pairs feed two branches, the member flags and the result, so they
    are computed once: written to the shared folder by default, or persisted
    with ``hold=keep``.

    Flags are per member over all its base pairs. Run dates are left out: two
    runs of one case and member are one row.
    """
    base = hold(base_pairs(tables, rules))
    rows = base.drop(*rules.flags).join(eligible_people(tables, rules, base), "member_id")
    if rules.flags:
        flags = base.groupBy("member_id").agg(
            *[F.max(name).alias(name) for name in rules.flags]
        )
        rows = rows.join(flags, "member_id", "left").withColumns(
            {n: F.when(F.col(n), "Y").otherwise("N") for n in rules.flags}
        )
    rows = rows.withColumn("assistance_cd", F.lit(rules.assistance_cd))
    if tables.languages is not None:
        names = tables.languages.select(
            F.col("code").alias("read_lang"), F.col("description").alias("language")
        )
        rows = rows.join(names, "read_lang", "left")
    return rows.drop("read_lang")


# --- contacts --------------------------------------------------------------


def contact_list(
    population: DataFrame,
    cases: DataFrame,
    phone_xref: DataFrame,
    phones: DataFrame,
    representatives: DataFrame,
    phone_types: DataFrame,
    identified_on: dt.date,
    as_of: dt.date,
    hold: Callable[[DataFrame], DataFrame] = materialize,
) -> DataFrame:
    """Whom to call per case: its representatives, else its verified numbers, else 'NA'.

    A case with a representative needs its own numbers only for their type, so
    these collapse before the representatives are joined; numbers and
    representatives of one case are never paired off.
    """
    open_end = F.col("end_dt").isNull() | (F.col("end_dt") > F.lit(as_of))
    reps = (
        representatives.filter((F.col("rep_type") == "S") & open_end)
        .select("case_id", F.col("phone").alias("rep_phone"))
        .distinct()
    )
    represented = reps.select("case_id").distinct().withColumn("rep_available", F.lit("Y"))
    types = phone_types.select(
        F.col("code").alias("type_cd"), F.col("description").alias("type_name")
    )
    # Distinct here, on the join's own partitioning, keeps the rows below distinct.
    wanted = (
        _asked_cases(cases)
        .join(population.select("case_id").distinct(), "case_id", "left_semi")
        .select("case_id", "sms_pref")
        .distinct()
    )
    numbers = (
        verified_phones(phone_xref, phones)
        .join(types, "type_cd")
        .join(represented, "case_id", "left")
        .withColumn("own", F.when(F.col("rep_available").isNull(), F.col("number")))
        .select("case_id", "type_name", "rep_available", "own")
        .distinct()
    )
    callable_cases = hold(numbers.join(wanted, "case_id"))
    rows = left_join_many(callable_cases, reps, "case_id")
    phone = (
        F.when(F.col("rep_available") == "Y", F.col("rep_phone"))
        .when(F.col("own").isNotNull(), F.col("own"))
        .otherwise(F.lit("NA"))
    )
    return rows.select(
        "case_id",
        phone.alias("phone"),
        F.coalesce("type_name", F.lit("NA")).alias("phone_type"),
        flag_or_no(F.col("sms_pref")).alias("opt_in"),
        F.coalesce("rep_available", F.lit("N")).alias("rep_available"),
        F.lit(identified_on).alias("identified_on"),
    )

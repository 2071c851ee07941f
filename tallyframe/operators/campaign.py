"""Campaign batches: append new rows, pick a batch, write requests, mark them sent.

Each function gives the rows to write; the caller writes them. All can be run
again: rows already in the target are left out, flags already set keep their
date. Run dates are arguments.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tallyframe.functions.dates import NEVER_ENDS, day_month_year
from tallyframe.functions.text import CODE_PATTERN, byte_length, capped, fill_placeholders, is_over, next_code
from tallyframe.plans.cutoff import cutoffs
from tallyframe.plans.lineage import materialize
from tallyframe.plans.ordered import number_rows
from tallyframe.sources import ledger
from tallyframe.sources.catalog import append_by_name

LANGUAGES = ("en", "pt", "es")

# Marks of a request and of a note, runs per campaign, days to reply.
REQUEST_TYPE = "S"
REQUEST_SOURCE = "MANUAL"
NOTE_KIND = "OTHE"
RUNS = 5
REPLY_DAYS = 15


# --- append ----------------------------------------------------------------


def new_rows(rows: DataFrame, target: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys the target does not hold yet."""
    return rows.join(target.select(*keys).distinct(), list(keys), "left_anti")


def append_new(df: DataFrame, name: str, *keys: str) -> int:
    """Append the rows whose keys the table does not hold yet; says how many.

    A second run with the same rows appends nothing.
    """
    seen = df.sparkSession.table(name)
    fresh, counter = counted(new_rows(df, seen, *keys), f"append to {name}")
    append_by_name(fresh, name)
    return counter.get["rows"]


def once_per_tag(rows: DataFrame, target: DataFrame, tag: str, column: str = "created_by") -> DataFrame:
    """All rows if no target row carries the tag, none otherwise.

    The test is one subquery that stops at the first tagged row.
    """
    return rows.filter(~target.filter(F.col(column) == tag).exists())


def next_id(target: DataFrame, column: str) -> Column:
    """The number after the highest in ``column``; 1 for an empty target."""
    return target.agg((F.coalesce(F.max(column), F.lit(0)) + 1).alias("next")).scalar()


# --- batch -----------------------------------------------------------------


def untriggered(flag: str) -> Column:
    return F.coalesce(F.col(flag), F.lit("N")) == "N"


def pick_batch(contacts: DataFrame, runs: int = RUNS, flag: str = "triggered") -> DataFrame:
    """Cases of the next run: a ``runs``-th of all cases, the last run the rest.

    The share is floor(total / runs). When no more are left than the last run
    would get, all of them are picked; so with fewer cases than runs the first
    run takes everything. Cases are taken in key order, a missing key first.

    The last key that is picked is found by histograms; cases are not sorted.
    Keys that are no whole numbers are numbered instead.
    """
    per_case = materialize(contacts.groupBy("case_id").agg((~F.max(untriggered(flag))).alias("done")))
    counts = per_case.agg(F.count(F.lit(1)).alias("total"), F.count(F.when(~F.col("done"), 1)).alias("remaining")).first()
    share = counts["total"] // runs
    pick = counts["remaining"] if counts["remaining"] <= counts["total"] - (runs - 1) * share else share
    waiting = per_case.filter(~F.col("done")).select("case_id")
    if pick == counts["remaining"]:
        return waiting
    if dict(per_case.dtypes)["case_id"] not in ("tinyint", "smallint", "int", "bigint"):
        return number_rows(waiting, "case_id", into="rn").filter(F.col("rn") <= pick).select("case_id")
    order = F.coalesce(F.col("case_id").cast("bigint"), F.lit(-(1 << 63)))
    keyed = waiting.withColumn("__order", order)
    cut = cutoffs(keyed, "__order", {None: pick})[None]
    return keyed.filter(F.col("__order") <= cut.value if cut else F.lit(False)).select("case_id")


# --- templates -------------------------------------------------------------


@dataclass(frozen=True)
class MessageTemplate:
    """A short message in the three languages."""

    description: str
    texts: Mapping[str, str]


@dataclass(frozen=True)
class NoticeTemplate:
    """A letter in the three languages; ``[DUE_DATE]`` stands for the reply date."""

    titles: Mapping[str, str]
    texts: Mapping[str, str]


def latest_code(code: str) -> Column:
    """The code with the highest trailing number: SMS100 comes after SMS99."""
    number = F.regexp_extract(code, CODE_PATTERN, 2)
    return F.max_by(code, F.struct(number.try_cast("bigint"), F.col(code)))


def template_row(
    templates: DataFrame,
    template: MessageTemplate,
    run_date: dt.date,
    created_by: str,
    first_code: str = "SMS01",
) -> DataFrame:
    """The template's row under the next free code, or the first code if there is none;
    empty if the tag has a row already."""
    code = F.coalesce(next_code(latest_code("code")), F.lit(first_code))
    row = templates.agg(code.alias("code")).select(
        "code",
        F.lit(template.description).alias("description"),
        *[F.lit(template.texts[x]).alias(f"text_{x}") for x in LANGUAGES],
        *[F.length(F.lit(template.texts[x])).alias(f"len_{x}") for x in LANGUAGES],
        F.lit(run_date).alias("begin_dt"),
        F.lit(None).cast("date").alias("end_dt"),
        F.lit(created_by).alias("created_by"),
    )
    return once_per_tag(row, templates, created_by)


def template_dates(
    templates: DataFrame, children: DataFrame, run_date: dt.date, created_by: str
) -> DataFrame:
    """The child row (code and dates) of each template with the tag that has none."""
    tagged = templates.filter(F.col("created_by") == created_by).select("code")
    return new_rows(tagged, children, "code").select(
        "code",
        F.lit(run_date).alias("begin_dt"),
        F.lit(None).cast("date").alias("end_dt"),
        F.lit(NEVER_ENDS).alias("archive_dt"),
    )


# --- requests and notes ----------------------------------------------------


def message_requests(
    batch: DataFrame,
    template_code: str | Column,
    run_date: dt.date,
    run_ts: dt.datetime,
    created_by: str,
    first_id: int | Column = 1,
) -> DataFrame:
    """One message request per distinct case of the batch."""
    code = template_code if isinstance(template_code, Column) else F.lit(template_code)
    cases = batch.select("case_id").distinct()
    numbered = number_rows(cases, "case_id", into="request_id", start=first_id)
    return numbered.select(
        "request_id",
        F.col("case_id").cast("string").alias("case_id"),
        code.alias("template_code"),
        F.lit("N").alias("processed"),
        F.lit(run_date).alias("request_dt"),
        F.lit(REQUEST_TYPE).alias("req_type"),
        F.lit(REQUEST_SOURCE).alias("trigger_source"),
        F.col("request_id").alias("history_id"),
        F.lit(created_by).alias("created_by"),
        F.lit(run_ts).alias("created_at"),
        F.col("request_id").alias("trans_id"),
        F.lit(NEVER_ENDS).alias("archive_dt"),
    )


def filled_texts(
    rows: DataFrame, texts: Mapping[str, str], values: Mapping[str, Column], into: str = "text"
) -> DataFrame:
    """Add one filled text column per language; the templates are literals, not a join."""
    return rows.withColumns(
        {
            f"{into}_{lang}": fill_placeholders(F.lit(text), dict(values))
            for lang, text in texts.items()
        }
    )


def notice_requests(
    population: DataFrame,
    template: NoticeTemplate,
    run_ts: dt.datetime,
    created_by: str,
    first_id: int | Column = 1,
    reply_days: int = REPLY_DAYS,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One letter request per case not yet noticed, in all languages."""
    run_date = run_ts.date()
    cases = population.filter(untriggered("notice_triggered")).select("case_id").distinct()
    numbered = number_rows(cases, "case_id", into="request_id", start=first_id)
    due = day_month_year(F.date_add(F.lit(run_date), reply_days))
    filled = filled_texts(numbered, template.texts, {"DUE_DATE": due, **(extra or {})})
    return filled.select(
        "request_id",
        *[F.lit(template.titles[x]).alias(f"title_{x}") for x in LANGUAGES],
        *[f"text_{x}" for x in LANGUAGES],
        F.lit(run_date).alias("schedule_dt"),
        F.col("case_id").cast("string").alias("case_list"),
        F.lit("N").alias("processed"),
        F.lit(created_by).alias("created_by"),
        F.lit(run_ts).alias("created_at"),
        F.col("request_id").alias("trans_id"),
        F.col("request_id").alias("history_id"),
        F.lit(NEVER_ENDS).alias("archive_dt"),
    )


def case_notes(
    noticed: DataFrame,
    cases: DataFrame,
    notes: DataFrame,
    text: str,
    run_date: dt.date,
    created_by: str,
    kind: str = NOTE_KIND,
    page: str = "NOTICE",
    first_id: int | Column = 1,
) -> DataFrame:
    """One note per case that exists and has none under this tag yet."""
    due = new_rows(
        noticed.select("case_id").distinct().join(
            cases.select("case_id").distinct(), "case_id", "left_semi"
        ),
        notes.filter(F.col("created_by") == created_by),
        "case_id",
    )
    return number_rows(due, "case_id", into="note_id", start=first_id).select(
        "case_id",
        "note_id",
        F.lit(kind).alias("kind"),
        F.col("note_id").alias("history_id"),
        F.lit(created_by).alias("created_by"),
        F.lit(run_date).alias("created_dt"),
        F.col("note_id").alias("trans_id"),
        F.lit(NEVER_ENDS).alias("archive_dt"),
        F.lit(text).alias("text"),
        F.lit(page).alias("page"),
    )


# --- flags -----------------------------------------------------------------


def requested_cases(
    requests: DataFrame,
    created_by: str,
    since: dt.datetime | None = None,
    column: str = "case_id",
    split_lists: bool = False,
) -> DataFrame:
    """Distinct case ids found in request texts under a tag, optionally from a time on.

    Text that is no number is skipped. A comma list is no number either unless
    ``split_lists`` takes it apart.
    """
    rows = requests.filter(F.col("created_by") == created_by)
    if since is not None:
        # Written as text: a Python time would pass through the machine's own time zone.
        kind = dict(requests.dtypes)["created_at"]
        rows = rows.filter(F.col("created_at") >= F.lit(str(since)).cast(kind))
    text = F.col(column)
    if split_lists:
        text = F.explode(F.split(text, ","))
    ids = rows.select(text.alias("t")).select(F.trim("t").try_cast("bigint").alias("case_id"))
    return ids.filter(F.col("case_id").isNotNull()).distinct()


def mark_triggered(
    target: DataFrame,
    sent: DataFrame,
    when: Column,
    flag: str = "triggered",
    date: str = "triggered_on",
    only_undated: bool = False,
) -> DataFrame:
    """The target with rows of ``sent`` cases flagged 'Y' and dated.

    Rows flagged before keep their date; with ``only_undated`` so do rows that
    carry a date without the flag. Every row and column stays; the result is a
    new snapshot of the table.
    """
    hits = sent.select("case_id").distinct().withColumn("__sent", F.lit(True))
    open_row = untriggered(flag)
    if only_undated:
        open_row = open_row & F.col(date).isNull()
    joined = target.join(hits, "case_id", "left")
    newly = F.coalesce(F.col("__sent"), F.lit(False)) & open_row
    kinds = dict(target.dtypes)
    # Both columns test the old flag, so they are set in one step.
    return joined.withColumns(
        {
            flag: F.when(newly, "Y").otherwise(F.col(flag)),
            date: F.when(newly, when.cast(kinds[date])).otherwise(F.col(date)),
        }
    ).select(*target.columns)


def mark_triggered_in(
    table: ledger.Table,
    sent: DataFrame,
    when: dt.date,
    run_id: str,
    flag: str = "triggered",
    date: str = "triggered_on",
    only_undated: bool = False,
) -> tuple[int, int]:
    """:func:`mark_triggered` on a table with a log: only files with a row to flag are written anew.

    Says how many files were, and how many stayed.
    """
    due = f"coalesce({flag}, 'N') = 'N'" + (f" and {date} is null" if only_undated else "")
    change = lambda rows: mark_triggered(rows, sent, F.lit(when), flag, date, only_undated)
    return ledger.update(table, sent.select(F.col("case_id").cast(table.schema["case_id"].dataType)), change, run_id, due)


# --- text length -----------------------------------------------------------


def over_limit(df: DataFrame, limit: int, *columns: str) -> DataFrame:
    """Rows with a text above the byte limit, and which columns are over."""
    over = F.filter(
        F.array(*[F.when(byte_length(F.col(c)) > limit, F.lit(c)) for c in columns]),
        lambda name: name.isNotNull(),
    )
    return df.withColumn("over_columns", over).filter(F.size("over_columns") > 0)


def fail_if_over(df: DataFrame, limit: int, *columns: str) -> DataFrame:
    """The same rows; the job that reads them fails at a text above the byte limit.

    The check rides along with the write, so the data is not read a second time.
    """
    checked = {
        c: F.when(
            byte_length(F.col(c)) > limit,
            F.raise_error(F.concat(F.lit(f"{c} is above {limit} bytes: "), byte_length(F.col(c)))),
        ).otherwise(F.col(c))
        for c in columns
    }
    return df.withColumns(checked)


def cap_texts(df: DataFrame, limit: int, *columns: str) -> DataFrame:
    """Texts cut to ``limit`` characters, with ``truncated`` true where any was longer."""
    cut = F.lit(False)
    for column in columns:
        cut = cut | F.coalesce(is_over(F.col(column), limit), F.lit(False))
    return df.withColumn("truncated", cut).withColumns(
        {c: capped(F.col(c), limit) for c in columns}
    )


def swap_column(df: DataFrame, column: str, kind: str) -> DataFrame:
    """A column under its old name and place with a new type: copy, drop, rename."""
    spare = f"{column}__new"
    order = df.columns
    swapped = df.withColumn(spare, F.col(column).cast(kind)).drop(column)
    return swapped.withColumnRenamed(spare, column).select(*order)


# --- counting --------------------------------------------------------------


def counted(df: DataFrame, step: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that fills while a write runs.

    Read ``observation.get["rows"]`` after the action. Unlike an accumulator it
    counts a retried task once.
    """
    observation = Observation(step)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def run_report(observations: Sequence[Observation], names: Sequence[str]) -> dict[str, int]:
    """Rows written per step, after the writes."""
    return {name: seen.get["rows"] for name, seen in zip(names, observations)}

"""Explicit schemas of the tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _table(text: str) -> T.StructType:
    """Schema from ``name type, ...``; unlike a DDL string it needs no running session."""
    fields = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Retail and staff files
CUSTOMERS = _table("customer_id int, name string, country string, age int, gender string")
ORDERS = _table(
    "order_id int, customer_id int, product string, category string, "
    "quantity int, price double, order_date date"
)
EMPLOYEES = _table(
    "employee_id int, name string, department string, salary int, location string"
)
EMPLOYEE_SALES = _table("sales_id int, employee_id int, product string, amount double")
SALES = _table(
    "order_id int, customer_id string, product string, category string, "
    "quantity int, amount int, order_date date"
)

# Population tables
CASES = _table("case_id bigint, sms_pref string, read_lang string")
ELIGIBILITY = _table(
    "case_id bigint, trace_id bigint, assistance_cd string, program_cd string, "
    "run_dt date, status_cd string, current_ind string, payment_end_dt date, delete_sw string"
)
MEMBER_ELIGIBILITY = _table(
    "case_id bigint, trace_id bigint, member_id bigint, target_sw string"
)
MEMBERS = _table("member_id bigint, person_key string, birth_dt date")
DEMOGRAPHICS = _table("member_id bigint, citizen_sw string, eff_end_dt date")
EXCLUSION_SPANS = _table(
    "member_id bigint, eff_begin_dt date, eff_end_dt date, event_end_dt date, due_dt date"
)
EXTERNAL_STATUS = _table("person_key string, status_cd string, seq_num bigint")
PHONE_XREF = _table("phone_seq bigint, source_id bigint, source_type string")
PHONES = _table("phone_seq bigint, number string, type_cd string, verified_sw string")
REPRESENTATIVES = _table(
    "case_id bigint, phone string, phone_type string, email string, "
    "contact_method string, rep_type string, end_dt date"
)
CODE_LOOKUP = _table("code string, description string")

# Campaign targets
POPULATION = _table(
    "case_id bigint, member_id bigint, assistance_cd string, inserted_at timestamp"
)
CONTACTS = _table(
    "case_id bigint, phone string, phone_type string, opt_in string, rep_available string, "
    "identified_on date, triggered string, triggered_on date, trigger_status string, "
    "comment string"
)
TRIGGER_INFO = _table(
    "case_id bigint, member_id bigint, assistance_cd string, "
    "notice_triggered string, notice_triggered_dt timestamp, "
    "sms_triggered string, sms_triggered_dt timestamp, "
    "email_triggered string, email_triggered_dt timestamp"
)
NOTICE_POPULATION = _table(
    "case_id bigint, member_id bigint, assistance_cd string, "
    "notice_triggered string, notice_triggered_dt timestamp"
)
TEMPLATES = _table(
    "code string, description string, text_en string, text_pt string, text_es string, "
    "len_en int, len_pt int, len_es int, begin_dt date, end_dt date, created_by string"
)
REQUESTS = _table(
    "request_id bigint, case_id string, template_code string, processed string, "
    "request_dt date, req_type string, trigger_source string, history_id bigint, "
    "created_by string, created_at timestamp, trans_id bigint, archive_dt date"
)
NOTICE_REQUESTS = _table(
    "request_id bigint, title_en string, title_pt string, title_es string, "
    "text_en string, text_pt string, text_es string, schedule_dt date, case_list string, "
    "processed string, created_by string, created_at timestamp, trans_id bigint, "
    "history_id bigint, archive_dt date"
)
NOTES = _table(
    "case_id bigint, note_id bigint, kind string, history_id bigint, created_by string, "
    "created_dt date, trans_id bigint, archive_dt date, text string, page string"
)

# Event stream
EVENTS = _table(
    "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
)

"""Cleaning raw tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

from tallyframe.functions.numbers import as_flag
from tallyframe.functions.text import blank_to_null, first_number


def tidy_names(df: DataFrame) -> DataFrame:
    """Column names trimmed, lower case, blanks as underscores."""
    return df.toDF(*["_".join(name.strip().lower().split(" ")) for name in df.columns])


def present_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Those of ``names`` the frame has, in the order given."""
    have = set(df.columns)
    return [name for name in names if name in have]


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def columns_of_type(df: DataFrame, *types: str) -> list[str]:
    """Names of columns whose type starts with one of ``types`` (``decimal`` fits all decimals)."""
    return [name for name, kind in df.dtypes if kind.startswith(types)]


def text_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, "string")


def number_columns(df: DataFrame) -> list[str]:
    return columns_of_type(
        df, "tinyint", "smallint", "int", "bigint", "float", "double", "decimal"
    )


def prefixed_columns(df: DataFrame, prefix: str) -> list[str]:
    return [name for name in df.columns if name.startswith(prefix)]


def strip_text(df: DataFrame, *names: str) -> DataFrame:
    """Trim the named text columns (all of them by default); blank becomes NULL."""
    return df.withColumns({n: blank_to_null(F.col(n)) for n in names or text_columns(df)})


def cast_columns(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast by name; text that does not fit becomes NULL instead of failing the job."""
    kinds = dict(df.dtypes)
    out = {}
    for name, kind in casts.items():
        column = F.col(name)
        if kind == "int" and kinds[name] == "string":
            # "42.0" is a whole number; try_cast("int") on the text would reject it.
            number = column.try_cast("double")
            out[name] = F.when(number == F.floor(number), number).try_cast("int")
        elif kinds[name] == "timestamp_ntz" and kind == "date":
            out[name] = column.cast("date")
        else:
            out[name] = column.try_cast(kind)
    return df.withColumns(out)


def clean_rows(df: DataFrame, casts: Mapping[str, str] | None = None) -> DataFrame:
    """Trim, drop rows with a NULL, cast, drop twins.

    Trimming comes first so that twins differing only in blanks are found. A
    row whose value does not fit its type stays, with NULL in that column;
    :func:`unfit_values` lists such rows with what they held.
    """
    return cast_columns(strip_text(df).na.drop(), casts or {}).dropDuplicates()


def unfit_values(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """The trimmed rows that lose a value in the cast, and ``unfit``: the names of its columns."""
    trimmed = strip_text(df).na.drop()
    cast = cast_columns(trimmed.withColumns({f"__{name}": F.col(name) for name in casts}), casts)
    lost = [F.when(F.col(name).isNull() & F.col(f"__{name}").isNotNull(), F.lit(name)) for name in casts]
    kept = [F.col(f"__{n}").alias(n) if n in casts else F.col(n) for n in df.columns]
    found = cast.withColumn("unfit", F.array_compact(F.array(*lost))).filter(F.size("unfit") > 0)
    return found.select(*kept, "unfit")


def clean_customers(customers: DataFrame) -> DataFrame:
    require_columns(customers, ("name", "country", "age", "gender"))
    return clean_rows(customers, {"age": "int"})


def clean_orders(orders: DataFrame) -> DataFrame:
    require_columns(orders, ("product", "category", "price", "order_date"))
    return clean_rows(orders, {"price": "double", "order_date": "date"})


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(values))


def recode_flags(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: as_flag(F.col(name)) for name in names})


def clean_claims(
    policy: DataFrame,
    car: DataFrame,
    claim: DataFrame,
    key: str = "policy_id",
    measured: Iterable[str] = ("max_torque", "max_power"),
    flag_prefix: str = "is_",
) -> DataFrame:
    """One row per policy with its car and claim, cleaned.

    Names tidied, text trimmed (missing stays missing), a ``*_num`` column for
    each measured text, flags recoded to 0/1. Columns a sheet does not have are
    skipped. Twins are dropped in each sheet before the join: the rows are the
    same, and a row repeated in two sheets does not first multiply.
    """
    sheets = [strip_text(tidy_names(sheet)).dropDuplicates() for sheet in (policy, car, claim)]
    rows = sheets[0].join(sheets[1], key).join(sheets[2], key)
    numbers = {
        f"{name}_num": first_number(F.col(name)) for name in present_columns(rows, measured)
    }
    rows = rows.withColumns(numbers) if numbers else rows
    flags = prefixed_columns(rows, flag_prefix)
    return recode_flags(rows, *flags) if flags else rows

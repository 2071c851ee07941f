"""Text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# First signed decimal number in a text; trailing digits of a code;
# characters that count as blank.
NUMBER_PATTERN = r"([-+]?\d*\.?\d+)"
CODE_PATTERN = r"^(.*?)(\d+)$"
BLANKS = " \t\n\x0b\f\r"


def strip(text: Column) -> Column:
    """Trim every kind of white space at both ends; NULL stays NULL."""
    return F.trim(text, F.lit(BLANKS))


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def first_number(text: Column) -> Column:
    """First number in a text as double; NULL if there is none."""
    return F.regexp_extract(text, NUMBER_PATTERN, 1).try_cast("double")


def yes_or_unset(flag: Column) -> Column:
    """True for 'Y', NULL and blank: an opt-out must be said."""
    said = blank_to_null(flag)
    return said.isNull() | (flag == "Y")


def flag_or_no(flag: Column) -> Column:
    """Upper-case trimmed flag; NULL and blank become 'N'."""
    return F.coalesce(blank_to_null(F.upper(flag)), F.lit("N"))


def joined(*parts: Column, sep: str = "\n") -> Column:
    """Concatenate, NULL parts read as empty text."""
    return F.concat_ws(sep, *[F.coalesce(p, F.lit("")) for p in parts])


def fill_placeholders(template: Column, values: dict[str, Column]) -> Column:
    """Replace each ``[NAME]`` in a template by its value; NULL values read as empty.

    The template is taken apart once: a value that looks like a placeholder
    stays as it is.
    """
    if not values:
        return template
    names = F.create_map(*[part for name, value in values.items() for part in (F.lit(name), F.coalesce(value.cast("string"), F.lit("")))])
    name = "|".join(re.escape(n) for n in values)
    texts = F.split(template, rf"\[(?:{name})\]", -1)
    found = F.regexp_extract_all(template, F.lit(rf"\[({name})\]"), F.lit(1))
    filled = F.transform(found, lambda n: names[n])
    pieces = F.zip_with(texts, filled, lambda text, value: F.concat(text, F.coalesce(value, F.lit(""))))
    return F.array_join(pieces, "")


def next_code(code: Column) -> Column:
    """The code after ``code``: trailing digits plus one, zero padding kept, carry allowed."""
    prefix = F.regexp_extract(code, CODE_PATTERN, 1)
    digits = F.regexp_extract(code, CODE_PATTERN, 2)
    following = (digits.cast("bigint") + 1).cast("string")
    width = F.greatest(F.length(digits), F.length(following))
    return F.concat(prefix, F.lpad(following, width, F.lit("0")))


def byte_length(text: Column) -> Column:
    return F.octet_length(text)


def capped(text: Column, limit: int) -> Column:
    """The first ``limit`` characters; pair with :func:`is_over`, which says if text was lost."""
    return F.substring(text, 1, limit)


def is_over(text: Column, limit: int) -> Column:
    return F.length(text) > limit

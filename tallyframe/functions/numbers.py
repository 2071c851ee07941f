"""Number expressions."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, functions as F

# Texts and numbers read as true and as false.
TRUE_WORDS = ("Yes", "True", "1")
FALSE_WORDS = ("No", "False", "0")


def money(value: Column) -> Column:
    """Exact cents. Sums of it widen by themselves, so totals do not overflow."""
    return value.cast("decimal(18,2)")


def total(value: Column) -> Column:
    """Sum of money, wide enough for any table."""
    return F.sum(value).cast("decimal(38,2)")


def exact(value: Column, kind: str) -> Column:
    """A value of type ``kind`` for exact sums: decimals as they are, binary
    fractions to eight places. What is summed is rounded once, by :func:`total`."""
    return value if kind.startswith("decimal") else value.cast("decimal(24,8)")


# Hundred-millionths are summed in two halves of a long; up to the limit a double holds them all.
_UNIT = 10**8
_HALF_BITS = 24
_ALL_IN_DOUBLE = 9e7


def exact_sum(value: Column, kind: str) -> Column:
    """Sum of amounts of type ``kind`` at their own scale, not rounded.

    Decimals are summed as they are. Binary fractions count to eight places, as
    :func:`exact` has them, but are added up as whole hundred-millionths in long
    arithmetic, so that a task makes no decimal object for a row; high and low
    bits have a sum each, so that neither overflows. Amounts too large for that
    are added as decimals.
    """
    if kind.startswith("decimal"):
        return F.sum(value)
    amount = value.cast("double")
    near = F.abs(amount) < _ALL_IN_DOUBLE
    units = F.when(near, F.rint(amount * _UNIT)).cast("bigint")
    high = F.sum(F.shiftright(units, _HALF_BITS)).cast("decimal(19,0)")
    low = F.sum(units.bitwiseAND(F.lit((1 << _HALF_BITS) - 1))).cast("decimal(19,0)")
    small = ((high * F.lit(Decimal(1 << _HALF_BITS)) + low) * F.lit(Decimal("0.00000001"))).cast("decimal(36,8)")
    large = F.sum(F.when(~near, value.cast("decimal(26,8)")))
    return F.coalesce(small + large, small, large)


def rounded(value: Column) -> Column:
    """A total to cents, for show."""
    return value.cast("decimal(38,2)")


def cents(value: Column) -> Column:
    """An amount with two decimals as whole cents; any other amount is an error.

    Long arithmetic instead of decimal objects, for sums over the lines of one
    order or product. Sum these again as decimals (:func:`from_cents`).
    """
    hundredfold = value.cast("double") * 100
    whole = F.rint(hundredfold)
    # Binary fractions are off by far less than a thousandth of a cent.
    off = F.abs(hundredfold - whole) > F.greatest(F.abs(whole) * 1e-12, F.lit(1e-3))
    return F.when(off, F.raise_error(F.lit("an amount has parts of a cent"))).otherwise(whole).cast("bigint")


def from_cents(value: Column) -> Column:
    return (value.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(38,2)")


def percent_of(part: Column, whole: Column) -> Column:
    """Share in percent, two places, half up."""
    return F.round(part * 100.0 / whole, 2)


def as_flag(
    value: Column,
    true_words: Iterable[str] = TRUE_WORDS,
    false_words: Iterable[str] = FALSE_WORDS,
) -> Column:
    """Yes/No and True/False to 1.0/0.0; other numbers kept, other text NULL."""
    text = value.cast("string")
    return (
        F.when(text.isin(list(true_words)), F.lit(1.0))
        .when(text.isin(list(false_words)), F.lit(0.0))
        .otherwise(text.try_cast("double"))
    )


def half_even(value: Column, places: int = 0) -> Column:
    return F.bround(value, places)

"""Classes of a value: bands by limits and classes by lookup."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Salary limits and band names, lowest first.
SALARY_LIMITS = (30000, 70000)
SALARY_BANDS = ("Low", "Medium", "High")


def band(
    value: Column,
    limits: Sequence[float] = SALARY_LIMITS,
    names: Sequence[str] = SALARY_BANDS,
) -> Column:
    """Name of the first band whose upper limit is above ``value``; NULL stays NULL."""
    out = F.when(value.isNull(), F.lit(None))
    for limit, name in zip(limits, names):
        out = out.when(value < limit, F.lit(name))
    return out.otherwise(F.lit(names[len(limits)]))


def member_class(
    value: Column, classes: Mapping[str, Iterable[str]], other: str = "Other"
) -> Column:
    """Name of the class whose list holds ``value``, else ``other``.

    For short lists. Longer ones belong in a table and a left join.
    """
    out = None
    for name, members in classes.items():
        test = value.isin(list(members))
        out = F.when(test, name) if out is None else out.when(test, name)
    return F.lit(other) if out is None else out.otherwise(F.lit(other))


@F.pandas_udf(T.StringType())
def band_in_pandas(value: pd.Series) -> pd.Series:
    """Salary band as a pandas UDF.

    The pattern for rules built-in functions cannot express; prefer :func:`band`,
    which stays in generated JVM code.
    """
    edges = [float("-inf"), *SALARY_LIMITS, float("inf")]
    named = pd.cut(value.astype("float64"), edges, right=False, labels=list(SALARY_BANDS))
    return named.astype(object).where(value.notna(), None)

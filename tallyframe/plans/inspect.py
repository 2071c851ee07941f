"""Plan text and schema display."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode=...)`` prints."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()


def describe_shape(df: DataFrame, sample: int = 5) -> dict:
    """Column types, row count and a few sample rows (any rows, order not promised)."""
    return {"columns": df.dtypes, "rows": df.count(), "sample": df.limit(sample).collect()}

"""Data checks that fail the job from inside the plan.

A check must sit in a column that is really produced: Catalyst prunes unused
columns, and a pruned ``raise_error`` never fires."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityzones.functions._col import as_col


def fail_if(condition: Column, value, message: str) -> Column:
    """``value``, or a job failure with ``message`` where ``condition`` holds."""
    return F.when(condition, F.raise_error(F.lit(message))).otherwise(as_col(value))


def require_not_null(df: DataFrame, cols) -> DataFrame:
    """Fail the job if any of ``cols`` is null; the columns keep their place."""
    checked = {
        c: fail_if(F.col(c).isNull(), c, f"column {c} must not be null") for c in cols
    }
    return df.withColumns(checked)

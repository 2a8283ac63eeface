"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityzones.session import materialize

# Words are maximal runs of anything but the six ASCII white-space characters.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def word_list(text: Column) -> Column:
    """Array of the words of ``text`` (null or blank text: empty array)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def unused(df: DataFrame, name: str) -> str:
    """``_name`` with as many underscores as it takes to differ from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    name = f"_{name}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_totals(df: DataFrame, order: list[Column | str], totals: dict[str, Column], name: str) -> DataFrame:
    """Append the inclusive running total of each expression in ``totals`` over the global ``order``.

    Two levels instead of one window over everything: rows are dealt out by
    ranges of ``order`` and written once; each range is summed (one row per
    range); ranges get the total of those before them; a window per range does
    the rest.  No task sees more than one range."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = materialize(
        df.repartitionByRange(*order).select("*", F.spark_partition_id().alias("_range")), f"{name}-ranged")
    sums = ranged.groupBy("_range").agg(*[F.sum(v).alias(f"_sum_{k}") for k, v in totals.items()])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        sums.select("_range", *[F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)).alias(f"_off_{k}")
                                for k in totals]), f"{name}-offsets")
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (ranged.join(offsets, "_range")
            .select(*[F.col(c) for c in df.columns],
                    *[(F.col(f"_off_{k}") + F.sum(v).over(inside)).alias(k) for k, v in totals.items()]))

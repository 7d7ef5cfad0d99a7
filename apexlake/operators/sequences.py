"""Operators over an ordered career.

Their input has one row per driver and race, so a window partition holds at
most one row per race on the calendar: it grows with years, not with data.
Collapse shared drives and sprints before calling them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def to_date(by: str, date: str, measure: Column) -> Column:
    """Running value up to and including everything on the same date."""
    return measure.over(Window.partitionBy(by).orderBy(date))


def last_rows(by: str, order: list[str], first: int, last: int, measure: Column) -> Column:
    """Value over a fixed number of rows around the current one."""
    return measure.over(Window.partitionBy(by).orderBy(*order).rowsBetween(first, last))


def islands(df: DataFrame, by: str, order: list[str], flags: dict[str, str], keep: list[str]) -> DataFrame:
    """Unbroken runs of rows where a flag holds, for several flags in one pass.

    Rows of one run share the number of rows before them that broke it, a
    running count that needs no second numbering. The grouping that follows is
    already clustered by ``by``, so the whole operator costs one shuffle.
    """
    career = Window.partitionBy(by).orderBy(*order)
    # One ordering for all counters: rows of the same order value are told
    # apart by position, so the running frame is in rows.
    so_far = career.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = df.select(
        by, *keep,
        F.row_number().over(career).alias("position"),
        F.lead(F.lit(1)).over(career).isNull().alias("is_newest"),
        *[F.col(flag) for flag in flags.values()],
        *[F.sum(F.when(F.col(f), 0).otherwise(1)).over(so_far).alias(f"breaks_{n}") for n, f in flags.items()],
    )
    runs = F.array(*[
        F.struct(F.lit(name).alias("run_type"), F.col(f"breaks_{name}").alias("run"), F.col(flag).alias("holds"))
        for name, flag in flags.items()
    ])
    unfolded = numbered.select(by, *keep, "position", "is_newest", F.inline(runs))
    return unfolded.where("holds").drop("holds")

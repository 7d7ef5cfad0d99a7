"""Gap of every row to the best of its group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apexlake.operators.joins import small_side


def group_gap(df: DataFrame, group: list[str], value: str, out: str, groups: int) -> DataFrame:
    """``value`` minus the group's smallest; null where the value or the group key is.

    The best per group is aggregated on the map side and looked up, because a
    window would bring every row of a group into one task. ``groups`` bounds
    the lookup table.
    """
    best = df.groupBy(*group).agg(F.min(value).alias("_best"))
    return df.join(small_side(best, groups), group, "left").withColumn(out, F.col(value) - F.col("_best")).drop("_best")

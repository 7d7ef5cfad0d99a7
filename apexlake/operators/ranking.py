"""Numbering and ranking that never put a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apexlake.operators.joins import measured_side, small_side
from apexlake.session import write_once

# monotonically_increasing_id keeps the partition in the bits above this one.
PARTITION_SHIFT = 33
# Neighbouring whole numbers whose distinct values are held in one array.
BLOCK = 1_000


def number_rows(df: DataFrame, group: list[str], order: list[Column], out: str) -> DataFrame:
    """``row_number()`` per group for groups of any size.

    A window would sort each group inside one task. Here a range sort over
    (group, order) spreads a large group over many tasks, the sorted rows are
    written once with a running id, and only one row per group and partition
    is needed to turn that id into a position within the group. These are
    counted and, unless there are many groups, broadcast, so the rows move once.
    ``order`` must be total, so that a re-run task numbers its rows the same way.
    """
    ordered = df.orderBy(*[F.col(c) for c in group], *order)
    placed = write_once(ordered.withColumn("_seq", F.monotonically_increasing_id()), f"numbered-{out}")
    placed = placed.withColumn("_part", F.shiftright("_seq", PARTITION_SHIFT))
    runs = placed.groupBy(*group, "_part").agg(F.min("_seq").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        *[F.col(c).alias(f"_g_{c}") for c in group], F.col("_part").alias("_p"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same = F.col("_part") == F.col("_p")
    for column in group:
        same = same & F.col(column).eqNullSafe(F.col(f"_g_{column}"))
    starts = measured_side(write_once(starts, f"starts-{out}"))
    return placed.join(starts, same).select(*df.columns, (F.col("_seq") + F.col("_shift")).alias(out))


def number_across(df: DataFrame, group: list[str], level: str, place: str, out: str) -> DataFrame:
    """Continue a numbering across the levels of a group.

    Rows already numbered 1, 2, .. within each level get the number of rows in
    earlier levels added. Only a row count per level is shuffled; the counts
    are written once, and the rows stay where they are unless there are many levels.
    """
    sizes = df.groupBy(*group, level).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, level, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    numbered = df.join(measured_side(write_once(starts, f"levels-{out}")), [*group, level])
    return numbered.withColumn(out, F.col("_start") + F.col(place)).drop("_start")


def dense_rank_rows(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """``dense_rank()`` ascending per group: number the distinct values, then look them up."""
    values = df.select(*group, value).where(F.col(value).isNotNull()).distinct()
    numbered = number_rows(values, group, [F.col(value)], out)
    return df.join(numbered, [*group, value], "left")


def dense_rank_integers(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """``dense_rank()`` ascending per group of a whole number, without sorting or writing rows.

    The distinct values of a group are gathered in blocks of ``BLOCK`` neighbouring
    numbers, so an array is bounded whatever the group holds, and a block
    starts where the counts of the blocks below it end. Distinct values are found
    before the shuffle. A null value has no rank.
    """
    block = F.floor(F.col(value) / BLOCK).alias("_block")
    blocks = df.where(F.col(value).isNotNull()).groupBy(*group, block).agg(F.sort_array(F.collect_set(value)).alias("_values"))
    earlier = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.size("_values")).over(earlier), F.lit(0))
    placed = blocks.withColumn("_start", start).select(*group, "_start", F.posexplode("_values").alias("_place", value))
    numbered = placed.select(*group, value, (F.col("_start") + F.col("_place") + 1).cast("int").alias(out))
    return df.join(numbered, [*group, value], "left")


def rank_by_histogram(df: DataFrame, by: str, value: str, out: str, distinct_values: int) -> DataFrame:
    """``rank()`` by descending value where few distinct values occur.

    Counting rows per value first leaves a table of at most ``distinct_values``
    rows; the rank of a value is one more than the rows above it. No task ever
    holds all rows of ``by``.
    """
    histogram = df.groupBy(by, value).agg(F.count("*").alias("_n"))
    above = Window.partitionBy(by).orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = histogram.select(
        by, value, (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).cast("int").alias(out)
    )
    return df.join(small_side(ranks, distinct_values), [by, value], "left")


def top_ranked(
    df: DataFrame, by: list[str], value: str, k: int, groups: int,
    ascending: bool = False, dense: bool = False, out: str = "place",
) -> DataFrame:
    """Rows ranked ``k`` or better per group, ties kept, however many rows are level.

    Rows are counted per value first, so a tie is one row; Spark then cuts each
    partition to the best ``k`` values before the shuffle. What is left, at
    most ``k`` values for each of ``groups`` groups, is looked up from the rows,
    which never come together in one task.
    """
    known = df.where(F.col(value).isNotNull())
    order = F.col(value).asc() if ascending else F.col(value).desc()
    best_first = Window.partitionBy(*by).orderBy(order)
    values = known.groupBy(*by, value).agg(F.count("*").alias("_n"))
    best = values.withColumn("_row", F.row_number().over(best_first)).where(F.col("_row") <= k)
    above = F.sum("_n").over(best_first.rowsBetween(Window.unboundedPreceding, -1))
    place = F.col("_row") if dense else (F.coalesce(above, F.lit(0)) + 1).cast("int")
    ranks = best.withColumn(out, place).where(F.col(out) <= k).select(*by, value, out)
    return known.join(small_side(ranks, groups * k), [*by, value])


def extreme_rows(df: DataFrame, value: str, smallest: bool) -> DataFrame:
    """All rows holding the table's extreme value: one row is broadcast, nothing is shuffled."""
    known = df.where(F.col(value).isNotNull())
    edge = known.agg((F.min if smallest else F.max)(value).alias("_edge"))
    return known.join(F.broadcast(edge), F.col(value) == F.col("_edge")).drop("_edge")

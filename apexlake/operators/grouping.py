"""Group-wise building blocks. All of them combine on the map side first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def collapse(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """One row per key."""
    return df.groupBy(*keys).agg(*[column.alias(name) for name, column in aggregates.items()])


def accumulate(parts: list[DataFrame], keys: list[str], **aggregates: Column) -> DataFrame:
    """Bring several sources to one row per key, keeping keys only one of them has.

    Equivalent to aggregating each source and full-outer-joining the results,
    with one shuffle in place of one per source. A column a source lacks is
    null in its rows.
    """
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return collapse(stacked, keys, **aggregates)


def latest_attributes(
    df: DataFrame, key: str, order: list[str], attributes: dict[str, str],
    when_known: dict[str, str] | None = None, **aggregates: Column,
) -> DataFrame:
    """Each key's most recent attributes.

    ``attributes`` come from the latest row, null or not. ``when_known`` skips
    rows where the value is missing. ``order`` ends in enough columns to break
    ties, so a name changed within a season still resolves the same way twice.
    """
    stamp = [F.col(c) for c in order]
    picks = [F.max(F.struct(*stamp, *[F.col(s).alias(f"v_{n}") for n, s in attributes.items()])).alias("newest")]
    for name, source in (when_known or {}).items():
        known = F.when(F.col(source).isNotNull(), F.struct(*stamp, F.col(source).alias("value")))
        picks.append(F.max(known).alias(f"known_{name}"))
    picks += [column.alias(name) for name, column in aggregates.items()]
    grouped = df.groupBy(key).agg(*picks)
    return grouped.select(
        key,
        *[F.col(f"newest.v_{name}").alias(name) for name in attributes],
        *[F.col(f"known_{name}.value").alias(name) for name in (when_known or {})],
        *aggregates,
    )


def directed_pairs(
    df: DataFrame, group: list[str], member: str, attributes: list[str],
    mine: str = "", theirs: str = "other_",
) -> DataFrame:
    """Both directions of every group that holds exactly two rows.

    The smallest and the largest struct of a two-row group are its two rows,
    so one aggregation replaces counting, joining back and joining the table
    to itself. A group of any other size costs one partial row per task and is
    dropped, however large it is. Two rows of the same member are no pair, and
    rows whose group is not known belong to none.
    """
    row = F.struct(member, *attributes)
    sides = (
        df.dropna(subset=group).groupBy(*group)
        .agg(F.count("*").alias("members"), F.min(row).alias("a"), F.max(row).alias("b"))
        .where((F.col("members") == 2) & (F.col(f"a.{member}") != F.col(f"b.{member}")))
    )
    both = F.array(
        F.struct(F.col("a").alias("me"), F.col("b").alias("you")),
        F.struct(F.col("b").alias("me"), F.col("a").alias("you")),
    )
    exploded = sides.select(*group, F.explode(both).alias("pair"))
    return exploded.select(
        *group,
        *[F.col(f"pair.me.{c}").alias(f"{mine}{c}") for c in [member, *attributes]],
        *[F.col(f"pair.you.{c}").alias(f"{theirs}{c}") for c in [member, *attributes]],
    )


def reconcile(a: DataFrame, b: DataFrame, keys: list[str], differs: Column, how: str = "left") -> DataFrame:
    """Rows of two independently derived tables that disagree."""
    return a.join(b, keys, how).where(differs)

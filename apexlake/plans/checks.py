"""Generic data checks. Each returns the violating rows, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from apexlake.functions.exprs import any_of

REPORT = ["table", "check_name", "target", "severity", "violations"]


# Violating rows --------------------------------------------------------------
def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Rows lacking a value in any of the columns."""
    return df.where(any_of([F.col(c).isNull() for c in columns]))


def unique(df: DataFrame, *keys: str) -> DataFrame:
    """Keys held by more than one row. Rows without a complete key are ``not_null``'s business."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def relationships(child: DataFrame, foreign: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a parent, with the rows that hold them; a null key passes.

    Keys are counted before the join, so one that a third of the rows share
    travels as a single row.
    """
    held = child.where(F.col(foreign).isNotNull()).groupBy(foreign).agg(F.count("*").alias("n"))
    return held.join(parent.select(F.col(key).alias(foreign)), foreign, "left_anti")


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside the list, with their count; null passes."""
    return df.where(~F.col(column).isin(values)).groupBy(column).agg(F.count("*").alias("n"))


def freshness(landings: DataFrame, now: Column, warn_days: int = 10, error_days: int = 30) -> DataFrame:
    """One row: newest landing time and whether it is too old.

    Takes the log of landings (``RawTable.landings``), a line per scope and load;
    pages, which carry the same time, would do as well but are scanned for it.
    """
    age = (F.unix_timestamp(now) - F.unix_timestamp("newest")) / 86400
    status = F.when(F.col("newest").isNull() | (age > error_days), "error").when(age > warn_days, "warn").otherwise("pass")
    return landings.agg(F.max("ingested_at").alias("newest")).select("newest", status.alias("status"))


# Reports ---------------------------------------------------------------------
@dataclass(frozen=True)
class Declared:
    """Checks declared per table: see ``quality.py``."""

    not_null: dict[str, dict[str, str]]
    unique: list[tuple[str, str]]
    combinations: dict[str, tuple[str, ...]]
    relationships: list[tuple[str, str, str]]
    accepted: list[tuple[str, str, list[str]]]


@dataclass(frozen=True)
class Line:
    """One line of a report."""

    table: str
    check_name: str
    target: str
    severity: str = "error"


# Figures taken while a table is written ------------------------------------------
def _nulls(column: str) -> str:
    return f"nulls: {column}"


def _unaccepted(column: str) -> str:
    return f"unaccepted: {column}"


def measures(table: str, declared: Declared) -> dict[str, Column]:
    """Counts that the declared checks of a table need of its rows: nulls, and values outside their list.

    Observed while the table is written, they cost no scan later.
    """
    counts = {_nulls(c): F.count_if(F.col(c).isNull()) for c in declared.not_null.get(table, {})}
    for name, column, values in declared.accepted:
        if name == table:
            counts[_unaccepted(column)] = F.count_if(~F.col(column).isin(values))
    return counts


def orphans(tables, keys: list[tuple[str, str, str]]) -> DataFrame:
    """Rows per foreign key (``table``, ``target``, ``n``) that hold a value without a parent; a null key passes.

    One scan per table and one shuffle for all keys: child and parent rows
    are turned into (parent table, key) and counted together, a column per
    foreign key. Counting starts before the shuffle, so a key that a third of
    the rows share travels as one row per task, and nothing is joined.
    """
    slots: dict[str, list[tuple[str, str]]] = {}
    for child, column, parent in keys:
        slots.setdefault(parent, []).append((child, column))
    own = {parent: next(c for _, c, p in keys if p == parent) for parent in slots}

    def held(entries: list[tuple[str, str, int]], df: DataFrame) -> DataFrame:
        found = [
            F.struct(F.lit(parent).alias("parent"), F.col(column).cast("string").alias("key"), F.lit(slot).alias("slot"))
            for parent, column, slot in entries
        ]
        return df.select(F.explode(F.array(*found)).alias("held")).select("held.*").where(F.col("key").isNotNull())

    scans: dict[str, list[tuple[str, str, int]]] = {parent: [(parent, column, -1)] for parent, column in own.items()}
    for parent, children in slots.items():
        for slot, (child, column) in enumerate(children):
            scans.setdefault(child, []).append((parent, column, slot))
    rows = reduce(DataFrame.unionByName, [held(entries, tables(name)) for name, entries in scans.items()])
    width = range(max(len(children) for children in slots.values()))
    counted = rows.groupBy("parent", "key").agg(
        F.bool_or(F.col("slot") == -1).alias("known"), *[F.count_if(F.col("slot") == i).alias(f"n{i}") for i in width])
    lost = counted.where(~F.col("known")).groupBy("parent").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in width])
    line = F.explode(F.array(*[F.struct(F.lit(i).alias("slot"), F.col(f"n{i}").alias("n")) for i in width])).alias("line")
    names = [
        x for parent, children in slots.items() for slot, (child, column) in enumerate(children)
        for x in (F.lit(f"{parent}/{slot}"), F.struct(F.lit(child).alias("table"), F.lit(f"{column} in {parent}").alias("target")))
    ]
    named = F.create_map(*names)[F.concat_ws("/", "parent", "line.slot")]
    return lost.select("parent", line).where(F.col("line.n") > 0).select(
        named["table"].alias("table"), named["target"].alias("target"), F.col("line.n").alias("n"))


def _null_checks(df: DataFrame, table: str, columns: dict[str, str]) -> DataFrame:
    """Nulls of all columns in one pass, tagged with the column."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return not_null(df, *columns).select(F.explode(missing).alias("target"))


def _report(spark: SparkSession, catalogue: list[Line], parts: list[DataFrame]) -> DataFrame:
    """Every check with its violations.

    All violations are counted in one aggregation, and usually there are few
    of them; the list of checks, a line each, fills in the zeros.
    """
    keys = ["table", "check_name", "target"]
    if not parts:
        parts = [spark.createDataFrame([], "table string, check_name string, target string, n bigint")]
    counted = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.sum("n").alias("violations"))
    lines = spark.createDataFrame(
        [(c.table, c.check_name, c.target, c.severity) for c in catalogue],
        "table string, check_name string, target string, severity string",
    )
    return lines.join(counted, keys, "left").select(
        *keys, "severity", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations")
    ).select(*REPORT)


def _tagged(df: DataFrame, table: str, check_name: str, target: Column, weight: Column) -> DataFrame:
    return df.select(
        F.lit(table).alias("table"), F.lit(check_name).alias("check_name"), target.alias("target"),
        weight.cast("bigint").alias("n"),
    )


def report(tables, declared: Declared, figures: Callable[[str], dict[str, int] | None] = lambda table: None) -> DataFrame:
    """Every declared check as one line with its number of violations.

    Nulls and orphans count rows; duplicates count keys; unaccepted values
    count values. ``figures`` knows the ``measures`` of tables that were counted
    while they were written; only others are scanned for nulls and unaccepted
    values, and a table that has some unaccepted value, to tell how many.
    """
    catalogue: list[Line] = []
    parts: list[DataFrame] = []
    known: list[tuple] = []
    counted = {table: figures(table) for table in {*declared.not_null, *[t for t, _, _ in declared.accepted]}}

    for table, columns in declared.not_null.items():
        catalogue += [Line(table, "not_null", c, s) for c, s in columns.items()]
        if counted[table] is None:
            found = _null_checks(tables(table), table, columns)
            parts.append(_tagged(found, table, "not_null", F.col("target"), F.lit(1)))
        else:
            known += [(table, "not_null", c, counted[table][_nulls(c)]) for c in columns]
    for table, column in declared.unique:
        catalogue.append(Line(table, "unique", column))
        lone = unique(tables(table).where(F.col(column).isNotNull()), column)
        parts.append(_tagged(lone, table, "unique", F.lit(column), F.lit(1)))
    for table, keys in declared.combinations.items():
        catalogue.append(Line(table, "unique_combination", ", ".join(keys)))
        parts.append(_tagged(unique(tables(table), *keys), table, "unique_combination", F.lit(", ".join(keys)), F.lit(1)))
    if declared.relationships:
        catalogue += [Line(table, "relationships", f"{column} in {parent}") for table, column, parent in declared.relationships]
        lost = orphans(tables, declared.relationships)
        parts.append(lost.select("table", F.lit("relationships").alias("check_name"), "target", F.col("n").cast("bigint").alias("n")))
    for table, column, values in declared.accepted:
        catalogue.append(Line(table, "accepted_values", column))
        if counted[table] is None or counted[table][_unaccepted(column)]:
            parts.append(_tagged(accepted_values(tables(table), column, values), table, "accepted_values", F.lit(column), F.lit(1)))
    spark = tables(catalogue[0].table).sparkSession
    if known:
        parts.append(spark.createDataFrame(known, "table string, check_name string, target string, n bigint"))
    return _report(spark, catalogue, parts)


def assertion_report(tables, assertions) -> DataFrame:
    """One line per assertion with its violations, in the same form.

    Each is counted by a job of its own. In one plan the driver would hold the
    broadcast sides of all of them at once, and describe the whole plan anew
    after each of its stages.
    """
    catalogue = [Line("all", "assertion", name, severity) for name, (_, severity) in assertions.items()]
    known = []
    for name, (check, _) in assertions.items():
        violating = check(tables)
        known.append(("all", "assertion", name, violating.count()))
    spark = violating.sparkSession
    return _report(spark, catalogue, [spark.createDataFrame(known, "table string, check_name string, target string, n bigint")])


def build_fails(report: DataFrame) -> DataFrame:
    """Lines that fail a build: violations at error level. Warnings are reported only."""
    return report.where((F.col("severity") == "error") & (F.col("violations") > 0))

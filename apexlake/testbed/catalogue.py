"""Models through the catalogue: descriptions in place, and marts saved and read back; with the SQL."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apexlake.plans.warehouse import COLUMN_DESCRIPTIONS, DESCRIPTIONS, MARTS, MODELS, Warehouse, catalogued
from apexlake.session import shared_folder


def _database(w: Warehouse) -> str:
    spark, name = w.colours.sparkSession, f"lake_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark)}/{name}'")
    return name


def descriptions(w: Warehouse) -> DataFrame:
    """Every column of every relation as the catalogue describes it, with the rows the catalogue finds in it."""
    spark, database = w.colours.sparkSession, _database(w)
    w.publish(database)
    listed = spark.createDataFrame(  # a line per column of the models
        [line for line in catalogued(spark, database) if line[2] in w.table(line[0]).columns],
        "relation string, description string, column string, comment string")
    counts = [spark.table(f"{database}.{name}").agg(F.lit(name).alias("relation"), F.count("*").alias("n")) for name in MODELS]
    return listed.join(F.broadcast(reduce(DataFrame.unionByName, counts)), "relation")


def round_trip(w: Warehouse) -> DataFrame:
    """The marts saved as tables and read back: rows, and rows that only one side has."""
    spark, database = w.colours.sparkSession, _database(w)
    w.save_marts(database)
    parts = []
    for name in MARTS:
        ours, saved = w.table(name), spark.table(f"{database}.{name}")
        sides = ours.select(F.struct(*ours.columns).alias("row"), F.lit(1).alias("side")).unionByName(
            saved.select(F.struct(*saved.columns).alias("row"), F.lit(-1).alias("side")))
        # A row and its copy cancel out; a hash tells rows apart, so they need not be compared side by side.
        odd = sides.groupBy(F.xxhash64(F.to_json("row"))).agg(F.abs(F.sum("side")).alias("odd"), F.count_if(F.col("side") == -1).alias("n"))
        parts.append(odd.agg(
            F.lit(name).alias("mart"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("odd"), F.lit(0)).alias("odd")))
    return reduce(DataFrame.unionByName, parts)


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


_COMMENTS = ", ".join(f"({_text(c)}, {_text(text)})" for c, text in COLUMN_DESCRIPTIONS.items())
QUERIES = {
    "catalogue_descriptions": (descriptions, " UNION ALL ".join(f"""
SELECT '{name}' AS relation, {_text(DESCRIPTIONS[name])} AS description, column_name AS "column", comment, (SELECT count(*) FROM {name}) AS n
FROM (DESCRIBE SELECT * FROM {name}) LEFT JOIN (VALUES {_COMMENTS}) AS c(column_name, comment) USING (column_name)""" for name in MODELS)),
    "catalogue_round_trip": (round_trip, " UNION ALL ".join(
        f"SELECT '{name}' AS mart, count(*) AS n, 0::BIGINT AS odd FROM {name}" for name in MARTS)),
}

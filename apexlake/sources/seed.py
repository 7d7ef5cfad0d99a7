"""Reference data: one colour per team.

Fixed values: ``seeds/team_colours.csv`` lists the published team colours, one
team per line, all columns text.
"""

from __future__ import annotations

import csv
from functools import reduce
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apexlake.sources.schemas import TEAM_COLOURS

_LINE = "_odd_line"


def seed_lines(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """The lines of a CSV file every executor can reach: rows of the schema, and lines that do not fit it as they are.

    A line fits if it has one value per column and none of them is missing.
    """
    with_line = T.StructType([*schema.fields, T.StructField(_LINE, T.StringType())])
    lines = spark.read.schema(with_line).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE).csv(path, header=header)
    whole = reduce(lambda a, b: a & b, [F.col(f.name).isNotNull() for f in schema], F.col(_LINE).isNull())
    odd = F.coalesce(F.col(_LINE), F.concat_ws(",", *[F.coalesce(F.col(f.name), F.lit("")) for f in schema]))
    return lines.where(whole).select(*schema.names), lines.where(~whole).select(odd.alias("line"))


def keep_odd_lines(lines: DataFrame, folder: str) -> DataFrame:
    """Add lines that do not fit to the seed's store of them, each load in files of its own; returns the store."""
    lines.withColumn("at", F.current_timestamp()).write.mode("append").parquet(folder)
    return lines.sparkSession.read.schema("line string, at timestamp").parquet(folder)


def read_team_colours(spark: SparkSession, path: str) -> DataFrame:
    """Team colours from a CSV file every executor can reach, lines that do not fit left out."""
    return seed_lines(spark, path, TEAM_COLOURS)[0]


def team_colour_rows() -> list[tuple[str, ...]]:
    """The 49 lines shipped with the package."""
    text = resources.files("apexlake.sources").joinpath("seeds/team_colours.csv").read_text("utf-8")
    return [tuple(line) for line in csv.reader(text.splitlines()[1:])]


def packaged_team_colours(spark: SparkSession) -> DataFrame:
    """The shipped colours, sent along with the plan."""
    return spark.createDataFrame(team_colour_rows(), TEAM_COLOURS)

"""A colour file made from the teams of the test tables, with lines that do not fit, and its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apexlake.plans.warehouse import Warehouse
from apexlake.session import shared_folder
from apexlake.sources.schemas import TEAM_COLOURS
from apexlake.sources.seed import keep_odd_lines, seed_lines
from apexlake.testbed.oracle import PARTS

# By the last digit of the hash: a missing value, a value too many, and a whole line otherwise.
_HASH, _KIND = "md5(constructor_id)", "substr(md5(constructor_id), 32, 1)"
_COLOUR = f"'#' || upper(substr({_HASH}, 1, 6))"
_TEXT = f"CASE WHEN substr({_HASH}, 31, 1) < '8' THEN '#000000' ELSE '#FFFFFF' END"
_LINE = f"""CASE WHEN {_KIND} = '0' THEN constructor_id || ',' || {_COLOUR}
     WHEN {_KIND} = '1' THEN constructor_id || ',' || {_COLOUR} || ',' || {_TEXT} || ',extra'
     ELSE constructor_id || ',' || {_COLOUR} || ',' || {_TEXT} END"""
PARTS["seed_source"] = f"SELECT constructor_id, {_KIND} AS kind, {_LINE} AS line FROM dim_constructor"
PARTS["seed_rows"] = f"""
SELECT constructor_id, {_COLOUR} AS team_colour, {_TEXT} AS text_colour FROM dim_constructor WHERE {_KIND} NOT IN ('0', '1')"""


def seed(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    """The lines written, then read as a seed: rows, and the store of odd lines."""
    spark = w.colours.sparkSession
    folder = f"{shared_folder(spark)}/seed-{uuid.uuid4().hex}"
    lines = w.table("dim_constructor").select(F.expr(_LINE).alias("line"))
    lines.write.text(f"{folder}/csv")
    rows, odd = seed_lines(spark, f"{folder}/csv", TEAM_COLOURS, header=False)
    return rows, keep_odd_lines(odd, f"{folder}/odd")


QUERIES = {
    "seed_team_colours": (lambda w: seed(w)[0], "SELECT * FROM seed_rows"),
    "seed_odd_lines": (lambda w: seed(w)[1].select("line"), """
SELECT line FROM seed_source WHERE kind IN ('0', '1')"""),
}

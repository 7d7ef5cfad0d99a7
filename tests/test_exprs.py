import datetime as dt

import pytest
from pyspark.sql import functions as F

from apexlake.functions import exprs as X


def one(spark, schema, values, column):
    return spark.createDataFrame([values], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text, seconds", [
    ("1:29.179", 89.179), ("1:31:44.742", 5504.742), ("0:59.999", 59.999), ("59.999", 59.999),
    ("2:00:00.000", 7200.0), (None, None), ("", None), ("no time", None),
    ("+22.457", None), ("1:2:3", None), (" ", None), ("1:1:1:1", None),
])
def test_duration(spark, text, seconds):
    got = one(spark, "t string", (text,), F.round(X.duration_seconds(F.col("t")), 3))
    assert got == seconds


@pytest.mark.parametrize("date, time, start", [
    ("2024-03-02", "15:00:00Z", dt.datetime(2024, 3, 2, 15)),
    ("1950-05-13", None, None), ("1950-05-13", "  ", None), (None, "15:00:00Z", None), ("2024-03-02", "late", None),
])
def test_session_start_is_null_without_a_time(spark, date, time, start):
    assert one(spark, "d string, t string", (date, time), X.session_start(F.col("d"), F.col("t"))) == start


@pytest.mark.parametrize("born, event, label", [
    ("1997-09-30", "2016-05-15", "18y 228d"),
    ("2000-05-10", "2020-05-10", "20y 0d"),
    ("2000-05-10", "2019-05-09", "18y 364d"),  # the day before a birthday, no 29 February in between
    ("2004-02-29", "2005-02-28", "1y 0d"),
    (None, "2020-01-01", None), ("2000-01-01", None, None),
])
def test_age_label(spark, born, event, label):
    got = one(spark, "b string, e string", (born, event), X.age_label(F.col("e").cast("date"), F.col("b").cast("date")))
    assert got == label


@pytest.mark.parametrize("position, points", [
    (1, 25), (2, 18), (3, 15), (4, 12), (5, 10), (6, 8), (7, 6), (8, 4), (9, 2), (10, 1), (11, 0), (None, 0),
])
def test_era_neutral_points(spark, position, points):
    assert one(spark, "p int", (position,), X.era_neutral_points(F.col("p"))) == points


@pytest.mark.parametrize("grid, finish, text, gained", [
    (10, 4, "4", 6), (0, 4, "4", None), (10, 18, "R", None), (None, 4, "4", None), (3, None, "3", None), (1, 5, "5", -4), (9, 4, None, 5),
])
def test_places_gained(spark, grid, finish, text, gained):
    column = X.places_gained(F.col("g"), F.col("f"), X.is_classified(F.col("t")))
    assert one(spark, "g int, f int, t string", (grid, finish, text), column) == gained


def test_race_key_and_label(spark):
    frame = spark.createDataFrame([(2024, 1, "Bahrain Grand Prix")], "season int, round int, name string")
    row = frame.select(X.race_id().alias("race_id"), X.race_label(F.col("round"), F.col("name")).alias("label")).select(
        "*", X.season_of().alias("season")).first()
    assert (row.race_id, row.label, row.season) == (202401, "R01 · Bahrain Grand Prix", 2024)

"""Shared logic between staging and the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apexlake.functions import exprs as X
from apexlake.operators.grouping import accumulate, collapse, directed_pairs
from apexlake.operators.joins import calendar_rows, small_side
from apexlake.operators.sequences import last_rows, to_date

RACE = ["season", "round"]
DRIVER_RACE = ["season", "round", "driver_id"]

RESULT_COLUMNS = [
    "grid_position", "finish_position", "finish_position_text", "points", "laps_completed", "status",
    "race_time_millis", "fastest_lap_rank", "fastest_lap_number", "fastest_lap_time", "fastest_lap_seconds",
]


def results_with_qualifying(results: DataFrame, races: DataFrame, qualifying: DataFrame) -> DataFrame:
    """Every car's result with its race and, where known, its driver's qualifying.

    Keeps the grain of the results: the calendar is unique per race and
    qualifying per driver and race.
    """
    calendar = races.select(*RACE, "race_name", "race_date", "race_start_utc", "circuit_id", "circuit_country")
    times = [F.col(f"q{n}_seconds") for n in (1, 2, 3)]
    sessions = qualifying.select(
        *DRIVER_RACE, "qualifying_position", *times, X.best_time(*times).alias("best_qualifying_seconds")
    )
    classified = X.is_classified(F.col("finish_position_text"))
    grid = F.col("grid_position")
    return (
        results.join(small_side(calendar, calendar_rows(races)), RACE, "left")
        .join(sessions, DRIVER_RACE, "left")
        .select(
            *DRIVER_RACE, "car_number", "constructor_id", "constructor_name",
            "race_name", "race_date", "race_start_utc", "circuit_id", "circuit_country",
            *RESULT_COLUMNS,
            "qualifying_position", "q1_seconds", "q2_seconds", "q3_seconds", "best_qualifying_seconds",
            classified.alias("was_classified"),
            X.places_gained(grid, F.col("finish_position"), classified).alias("positions_gained"),
            X.grid_penalty(grid, F.col("qualifying_position")).alias("grid_penalty_positions"),
        )
    )


def driver_form(joined: DataFrame, sprints: DataFrame, races: DataFrame) -> DataFrame:
    """Career-to-date totals and recent form per driver and race.

    Sprints count towards points, and a driver with only a sprint still has a
    row, which takes a slot in the five-race windows. Here the best finish is
    any numeric one, classified or not. Career totals include everything on the
    same date; the five-race windows are in rows, with the race itself breaking
    a tie on the date.
    """
    entries = accumulate(
        [
            joined.select(
                *DRIVER_RACE, F.col("points").alias("race"), "finish_position", "was_classified",
                "grid_position", F.lit(1).alias("car"),
            ),
            sprints.select(*DRIVER_RACE, F.col("points").alias("sprint")),
        ],
        DRIVER_RACE,
        race_points=F.coalesce(F.sum("race"), F.lit(0.0)),
        sprint_points=F.coalesce(F.sum("sprint"), F.lit(0.0)),
        best_finish_position=F.min("finish_position"),
        was_classified=X.flag(F.max("was_classified")),
        grid_position=F.min("grid_position"),
        cars_driven=F.count("car"),
    ).withColumn("points", F.col("race_points") + F.col("sprint_points"))
    dated = entries.join(
        small_side(races.select(*RACE, "race_date"), calendar_rows(races)), RACE, "left"
    )

    order = ["race_date", "season", "round"]
    points, won = F.sum("points"), X.as_count(F.col("best_finish_position") == 1)
    classified_finish = F.avg(F.when(F.col("was_classified"), F.col("best_finish_position")))
    # The row windows come first: their sort order begins with the date, so the
    # windows by date find their rows already in order.
    recent = dated.withColumns({
        "points_last_5_races": last_rows("driver_id", order, -4, 0, points),
        "avg_finish_last_5_races": F.round(last_rows("driver_id", order, -4, 0, classified_finish), 2),
        "points_in_previous_5_races": last_rows("driver_id", order, -5, -1, points),
    })
    return recent.select(
        *DRIVER_RACE, "race_date", "race_points", "sprint_points", "points", "best_finish_position",
        "was_classified", "grid_position", "cars_driven",
        to_date("driver_id", "race_date", F.count("*")).alias("career_races_to_date"),
        to_date("driver_id", "race_date", points).alias("career_points_to_date"),
        to_date("driver_id", "race_date", F.sum(won)).alias("career_wins_to_date"),
        "points_last_5_races", "avg_finish_last_5_races", "points_in_previous_5_races",
    )


def driver_race(joined: DataFrame, drivers: DataFrame) -> DataFrame:
    """One row per start, shared drives collapsed to the best classified finish."""
    starts = collapse(
        joined, [*DRIVER_RACE, "race_date"],
        cars_driven=F.count("*"),
        was_classified=F.max("was_classified"),
        best_finish_position=F.min(F.when(F.col("was_classified"), F.col("finish_position"))),
        best_grid_position=F.min("grid_position"),
        points=F.sum("points"),
    )
    born = drivers.select("season", "driver_id", "date_of_birth")
    finish = F.col("best_finish_position")
    return starts.join(born, ["season", "driver_id"], "left").select(
        *RACE, X.race_id().alias("race_id"), "race_date", "driver_id", "date_of_birth",
        F.datediff("race_date", "date_of_birth").alias("age_days"),
        "cars_driven", "was_classified", "best_finish_position", "best_grid_position", "points",
        X.flag(finish == 1).alias("won"),
        X.flag(finish <= 3).alias("podium"),
        X.flag(F.col("best_grid_position") == 1).alias("pole"),
        (F.col("points") > 0).alias("scored_points"),
        X.era_neutral_points(finish).alias("modern_points"),
    )


def teammate_qualifying(qualifying: DataFrame) -> DataFrame:
    """I4: each driver of a two-car team against the other, in the last session both timed."""
    names = {"Q3": "q3_seconds", "Q2": "q2_seconds", "Q1": "q1_seconds"}
    pairs = directed_pairs(
        qualifying, [*RACE, "constructor_id"], "driver_id",
        ["qualifying_position", *names.values()], theirs="teammate_",
    )
    mine = {n: F.col(c) for n, c in names.items()}
    theirs = {n: F.col(f"teammate_{c}") for n, c in names.items()}
    session = F.col("session_compared")
    timed = pairs.withColumn("session_compared", X.last_shared_session(mine, theirs)).withColumns({
        "qualifying_seconds": X.time_in(session, mine),
        "teammate_qualifying_seconds": X.time_in(session, theirs),
    })
    own, other = F.col("qualifying_seconds"), F.col("teammate_qualifying_seconds")
    return timed.select(
        *RACE, "constructor_id", "driver_id", F.col("teammate_driver_id").alias("teammate_id"),
        "qualifying_position", "teammate_qualifying_position", "session_compared",
        "qualifying_seconds", "teammate_qualifying_seconds",
        (own - other).alias("gap_seconds"),
        X.gap_percent(own, other).alias("gap_pct"),
        (F.col("qualifying_position") < F.col("teammate_qualifying_position")).alias("beat_teammate"),
    )

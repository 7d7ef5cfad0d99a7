"""The checks declared on each table. Keys, references, allowed values."""

from __future__ import annotations

from apexlake.plans.checks import Declared

RACE, DRIVER_RACE = ("season", "round"), ("season", "round", "driver_id")


def _errors(*columns: str, warn: tuple[str, ...] = ()) -> dict[str, str]:
    return {**dict.fromkeys(columns, "error"), **dict.fromkeys(warn, "warn")}


NOT_NULL = {
    "stg_races": _errors(*RACE, "race_date", "circuit_id"),
    "stg_results": _errors(*DRIVER_RACE, "constructor_id", "finish_position_text", "points", warn=("car_number",)),
    "stg_qualifying": _errors(*DRIVER_RACE),
    "stg_drivers": _errors("season", "driver_id", "full_name"),
    "stg_driver_standings": _errors("season", "driver_id", "championship_position_text", "championship_points", "wins"),
    "stg_constructor_standings": _errors("season", "constructor_id", "championship_position_text", "championship_points"),
    "stg_laps": _errors("season", "round", "lap", "driver_id", warn=("position",)),
    "stg_pit_stops": _errors(*DRIVER_RACE, "stop_number", "lap"),
    "stg_sprint_results": _errors(*DRIVER_RACE, "points"),
    "int_results_qualifying": _errors(*DRIVER_RACE, "race_name", "was_classified"),
    "int_driver_form": _errors(*DRIVER_RACE, "cars_driven"),
    "int_driver_race": _errors(*DRIVER_RACE, "race_id", "race_date", "pole", "modern_points"),
    "int_teammate_qualifying": _errors(*DRIVER_RACE, "constructor_id", "teammate_id"),
    "dim_season": _errors("season", "is_dropped_scores_era", "is_current_season"),
    "dim_race": _errors("race_id", "season", "race_name", "race_label", "race_date", "has_results"),
    "dim_driver": _errors("driver_id", "driver_name", "first_season"),
    "dim_constructor": _errors("constructor_id", "constructor_name", "team_colour", "text_colour"),
    "fct_race_results": _errors("race_id", "driver_id", "constructor_id", "was_classified", "is_fastest_lap"),
    "fct_points_by_round": _errors("race_id", "driver_id", "total_points"),
    "fct_driver_standings": _errors("season", "driver_id", "championship_points", "is_champion"),
    "fct_driver_careers": _errors("driver_id", "starts", "titles", "modern_points_per_start"),
    "fct_driver_streaks": _errors("driver_id", "streak_type", "streak_length", "streak_rank"),
    "fct_qualifying": _errors("race_id", "driver_id", "constructor_id"),
    "fct_lap_positions": _errors("race_id", "driver_id", "lap", "position", "is_pit_lap"),
    "fct_pit_stops": _errors("race_id", "driver_id"),
    "fct_teammate_qualifying": _errors("race_id", "driver_id", "constructor_id", "teammate_name"),
    "team_colours": _errors("constructor_id", "team_colour", "text_colour"),
}
UNIQUE = [
    ("dim_season", "season"), ("dim_race", "race_id"), ("dim_driver", "driver_id"),
    ("dim_constructor", "constructor_id"), ("fct_driver_careers", "driver_id"), ("team_colours", "constructor_id"),
]
COMBINATIONS = {
    "stg_races": RACE,
    "stg_results": (*DRIVER_RACE, "car_number"),
    "stg_qualifying": DRIVER_RACE,
    "stg_drivers": ("season", "driver_id"),
    "stg_driver_standings": ("season", "driver_id"),
    "stg_constructor_standings": ("season", "constructor_id"),
    "stg_laps": ("season", "round", "lap", "driver_id"),
    "stg_pit_stops": (*DRIVER_RACE, "stop_number"),
    "stg_sprint_results": DRIVER_RACE,
    "int_results_qualifying": (*DRIVER_RACE, "car_number"),
    "int_driver_form": DRIVER_RACE,
    "int_driver_race": DRIVER_RACE,
    "int_teammate_qualifying": DRIVER_RACE,
    "fct_race_results": ("race_id", "driver_id", "car_number"),
    "fct_points_by_round": ("race_id", "driver_id"),
    "fct_driver_standings": ("season", "driver_id"),
    "fct_driver_streaks": ("driver_id", "streak_type", "first_race_id"),
    "fct_qualifying": ("race_id", "driver_id"),
    "fct_lap_positions": ("race_id", "driver_id", "lap"),
    "fct_pit_stops": ("race_id", "driver_id", "stop_number"),
    "fct_teammate_qualifying": ("race_id", "driver_id"),
}
_RACE_FACTS = [
    "fct_race_results", "fct_points_by_round", "fct_qualifying", "fct_lap_positions", "fct_pit_stops",
    "fct_teammate_qualifying",
]
_DRIVER_FACTS = [*_RACE_FACTS, "fct_driver_standings", "fct_driver_careers", "fct_driver_streaks"]
RELATIONSHIPS = [
    *[(fact, "race_id", "dim_race") for fact in _RACE_FACTS],
    *[(fact, "driver_id", "dim_driver") for fact in _DRIVER_FACTS],
    *[(t, "constructor_id", "dim_constructor")
      for t in ("fct_race_results", "fct_qualifying", "fct_teammate_qualifying", "team_colours")],
    ("dim_race", "season", "dim_season"), ("fct_driver_standings", "season", "dim_season"),
]
ACCEPTED = [
    ("fct_driver_streaks", "streak_type", ["win", "podium", "points"]),
    ("int_teammate_qualifying", "session_compared", ["Q1", "Q2", "Q3"]),
    ("fct_qualifying", "final_session", ["Q1", "Q2", "Q3"]),
    ("team_colours", "text_colour", ["#000000", "#FFFFFF"]),
]
DECLARED = Declared(NOT_NULL, UNIQUE, COMBINATIONS, RELATIONSHIPS, ACCEPTED)

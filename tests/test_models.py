"""Models on small hand-written staging tables, one case per rule that is easy to get wrong."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from apexlake.plans import report
from apexlake.plans.assertions import ASSERTIONS
from apexlake.plans.warehouse import Warehouse
from apexlake.sources import staging
from apexlake.sources.seed import packaged_team_colours

from conftest import rows

DAY = dt.date


@pytest.fixture(scope="module")
def schemas(spark):
    empty = spark.createDataFrame([], "season int, payload string")
    return {name: model(empty).schema for name, model in staging.MODELS.values()}


@pytest.fixture(scope="module")
def lake(spark, schemas):
    def build(**tables):
        frames = {}
        for name, schema in schemas.items():
            given = tables.get(name.removeprefix("stg_"), [])
            frames[name] = spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in given], schema)
        return Warehouse({}, packaged_team_colours(spark), tables=frames)

    return build


def race(season, round, day=None, **more):
    return {"season": season, "round": round, "race_name": f"GP {round}", "race_date": day or DAY(season, round, 1), **more}


def result(season, round, driver, finish, points=0.0, text=None, car=1, grid=None, team="t", **more):
    return {"season": season, "round": round, "driver_id": driver, "constructor_id": team, "constructor_name": team.upper(),
            "car_number": car, "finish_position": finish, "finish_position_text": text or str(finish),
            "points": points, "grid_position": grid, "laps_completed": 50, **more}


def sprint(season, round, driver, finish, points):
    return {"season": season, "round": round, "driver_id": driver, "finish_position": finish, "points": points}


def quali(season, round, driver, position, team, q1=None, q2=None, q3=None):
    return {"season": season, "round": round, "driver_id": driver, "constructor_id": team, "qualifying_position": position,
            "q1_seconds": q1, "q2_seconds": q2, "q3_seconds": q3}


def driver(season, driver_id, born=None, **more):
    return {"season": season, "driver_id": driver_id, "full_name": driver_id.title(), "date_of_birth": born, **more}


def standing(season, driver_id, position, points, text=None, teams=("T",)):
    return {"season": season, "driver_id": driver_id, "championship_position": position, "championship_points": points,
            "championship_position_text": text or str(position), "wins": 0, "constructor_names": list(teams)}


def pick(df, *columns, **where):
    for name, value in where.items():
        df = df.where(F.col(name) == value)
    return rows(df.select(*columns))


# Shared drives -------------------------------------------------------------------
def test_a_shared_drive_is_one_start_and_two_cars(lake):
    w = lake(races=[race(1953, 1)], results=[
        result(1953, 1, "kim", 11, 0.0, text="R", car=7, grid=3), result(1953, 1, "kim", 2, 6.0, car=31, grid=6),
        result(1953, 1, "lee", 1, 8.0, car=1, grid=1)],
        drivers=[driver(1953, "kim"), driver(1953, "lee")],
        driver_standings=[standing(1953, "kim", 2, 6.0), standing(1953, "lee", 1, 8.0)])
    assert pick(w.table("int_driver_race"), "cars_driven", "best_finish_position", "best_grid_position", "podium",
                driver_id="kim") == {(2, 2, 3, True)}
    assert w.table("fct_race_results").count() == 3
    assert pick(w.table("fct_driver_standings"), "races_entered", "podiums", "did_not_finish", "avg_grid_position",
                driver_id="kim") == {(1, 1, 1, 4.5)}
    assert pick(w.table("fct_driver_careers"), "starts", "podiums", driver_id="kim") == {(1, 1)}
    assert pick(report.races_entered(w.table), "races_entered", driver_id="kim") == {(1,)}


def test_best_finish_means_two_things(lake):
    """Any numeric finish in the form, classified only per start."""
    w = lake(races=[race(1990, 1)], results=[result(1990, 1, "a", 1, text="D"), result(1990, 1, "b", 2)])
    assert pick(w.table("int_driver_form"), "best_finish_position", "career_wins_to_date", driver_id="a") == {(1, 1)}
    assert pick(w.table("int_driver_race"), "best_finish_position", "won", driver_id="a") == {(None, False)}


# Form ----------------------------------------------------------------------------
def test_career_totals_include_the_same_date_and_form_windows_count_rows(lake):
    days = [DAY(2000, 1, 1), DAY(2000, 2, 1), DAY(2000, 2, 1)]
    w = lake(races=[race(2000, i + 1, d) for i, d in enumerate(days)],
             results=[result(2000, i + 1, "a", 1, 10.0 * (i + 1)) for i in range(3)])
    got = pick(w.table("int_driver_form"), "round", "career_races_to_date", "career_points_to_date",
               "points_last_5_races", "points_in_previous_5_races")
    assert got == {(1, 1, 10.0, 10.0, None), (2, 3, 60.0, 30.0, 10.0), (3, 3, 60.0, 60.0, 30.0)}


def test_rolling_windows_hold_five_races(lake):
    w = lake(races=[race(2000, r) for r in range(1, 8)],
             results=[result(2000, r, "a", r, float(r), text="R" if r == 7 else None) for r in range(1, 8)])
    last = pick(w.table("int_driver_form"), "points_last_5_races", "points_in_previous_5_races",
                "avg_finish_last_5_races", round=7)
    assert last == {(25.0, 20.0, 4.5)}


def test_a_sprint_without_a_race_is_an_entry(lake):
    w = lake(races=[race(2024, 1), race(2024, 2)], results=[result(2024, 1, "a", 1, 25.0, grid=1)],
             sprint_results=[sprint(2024, 1, "a", 1, 8.0), sprint(2024, 2, "a", 2, 7.0)])
    form = w.table("int_driver_form")
    assert pick(form, "race_points", "sprint_points", "points", round=1) == {(25.0, 8.0, 33.0)}
    assert pick(form, "points", "was_classified", "best_finish_position", "grid_position", "cars_driven",
                "career_races_to_date", round=2) == {(7.0, False, None, None, 0, 2)}
    assert w.table("int_driver_race").count() == 1


def test_sprint_points_close_the_season(lake):
    w = lake(races=[race(2021, 22, DAY(2021, 12, 12))], results=[result(2021, 22, "max", 1, 388.5)],
             sprint_results=[sprint(2021, 22, "max", 1, 7.0)], driver_standings=[standing(2021, "max", 1, 395.5)])
    assert pick(w.table("fct_driver_standings"), "points_scored", "points_dropped") == {(395.5, 0.0)}
    assert pick(report.points_to_date(w.table), "points_to_date") == {(395.5,)}


# Championship ----------------------------------------------------------------------
def test_the_champion_is_published_not_summed(lake):
    w = lake(races=[race(1988, 1)], results=[result(1988, 1, "prost", 1, 105.0), result(1988, 1, "senna", 2, 94.0)],
             drivers=[driver(1988, "prost", DAY(1955, 2, 24)), driver(1988, "senna", DAY(1960, 3, 21))],
             driver_standings=[standing(1988, "senna", 1, 90.0, teams=("McLaren", "Lotus")), standing(1988, "prost", 2, 87.0)])
    standings = w.table("fct_driver_standings")
    assert pick(standings, "driver_id", "is_champion", "points_dropped") == {("senna", True, -4.0), ("prost", False, -18.0)}
    assert pick(standings, "constructor_names", driver_id="senna") == {("McLaren, Lotus",)}
    assert pick(w.table("dim_season"), "title_margin", "is_dropped_scores_era") == {(3.0, True)}
    assert pick(w.table("fct_driver_careers"), "titles", "age_first_title", driver_id="senna") == {(1, "27y 286d")}
    assert pick(report.championship_leader(w.table), "championship_leader") == {("Senna",)}


def test_no_champion_before_the_last_race(lake):
    w = lake(races=[race(2026, 1), race(2026, 2, sprint_date=DAY(2026, 2, 1))], results=[result(2026, 1, "a", 1, 25.0)],
             drivers=[driver(2026, "a")], driver_standings=[standing(2026, "a", 1, 25.0), standing(2026, "b", None, 0.0, "-")])
    assert pick(w.table("fct_driver_standings"), "driver_id", "is_champion", "races_entered", "poles") == {
        ("a", False, 1, 0), ("b", False, None, 0)}
    assert pick(w.table("dim_season"), "races_scheduled", "races_completed", "sprint_weekends_scheduled",
                "sprints_completed", "is_current_season", "title_margin") == {(2, 1, 1, 0, True, None)}
    assert pick(w.table("dim_race"), "race_id", "has_results", "is_sprint_weekend", "race_label") == {
        (202601, True, False, "R01 · GP 1"), (202602, False, True, "R02 · GP 2")}
    assert pick(report.season_progress(w.table), "season_progress") == {("1 of 2 rounds",)}


def test_leaders_level_at_the_top(lake):
    w = lake(races=[race(2021, 21, DAY(2021, 12, 5))], drivers=[driver(2021, "max"), driver(2021, "lewis"), driver(2021, "c")],
             driver_standings=[standing(2021, "max", 1, 369.5), standing(2021, "lewis", 2, 369.5), standing(2021, "c", 3, 9.0)])
    assert pick(report.season_cards(w.table), "championship_leader", "leader_margin") == {("Lewis, Max", 0.0)}


# Flags -------------------------------------------------------------------------------
def test_unknown_flags(lake):
    w = lake(races=[race(2000, 1)], results=[
        result(2000, 1, "a", None, None, text="1"), result(2000, 1, "b", 1, 0.0, text="R", fastest_lap_rank=1)])
    got = pick(w.table("fct_race_results"), "driver_id", "is_win", "is_podium", "scored_points", "is_fastest_lap")
    assert got == {("a", None, None, None, False), ("b", False, False, False, True)}
    assert pick(w.table("int_driver_race"), "driver_id", "won", "podium", "pole", "age_days") == {
        ("a", False, False, False, None), ("b", False, False, False, None)}


def test_pole_goes_to_every_driver_of_a_shared_car(lake):
    w = lake(races=[race(1951, 1)], results=[result(1951, 1, d, 1, 4.0, grid=1) for d in ("fagioli", "lee")])
    assert pick(w.table("int_driver_race"), "driver_id", "pole", "won") == {("fagioli", True, True), ("lee", True, True)}


# Qualifying ----------------------------------------------------------------------------
def test_gap_is_taken_within_the_last_session(lake):
    w = lake(races=[race(2024, 1)], results=[result(2024, 1, "max", 1, grid=1)], qualifying=[
        quali(2024, 1, "max", 1, "r", 90.0, 89.7, 89.179), quali(2024, 1, "charles", 2, "f", 90.1, 89.165, 89.407),
        quali(2024, 1, "out", 11, "s", 91.0, 90.0), quali(2024, 1, "none", 20, "s")])
    got = pick(w.table("fct_qualifying"), "driver_id", "final_session", F.round("gap_seconds", 3), "grid_position",
               "best_qualifying_seconds")
    assert got == {("max", "Q3", 0.0, 1, 89.179), ("charles", "Q3", 0.228, None, 89.165), ("out", "Q2", 0.0, None, 90.0),
                   ("none", None, None, None, None)}


def test_aggregate_qualifying_sums_two_laps(lake):
    w = lake(races=[race(2005, 1)], qualifying=[
        quali(2005, 1, "fisi", 1, "r", 92.0, 83.0), quali(2005, 1, "webber", 3, "w", 96.0, 82.536), quali(2005, 1, "one", 9, "w", 80.0)])
    got = pick(w.table("fct_qualifying"), "driver_id", F.round("final_session_seconds", 3), F.round("gap_seconds", 3), "final_session")
    assert got == {("fisi", 175.0, 0.0, None), ("webber", 178.536, 3.536, None), ("one", 80.0, 0.0, None)}


def test_teammates_meet_in_the_last_session_both_timed(lake):
    w = lake(races=[race(2024, 1)], drivers=[driver(2024, "a"), driver(2024, "b")], qualifying=[
        quali(2024, 1, "a", 5, "m", 90.0, 88.0, 87.0), quali(2024, 1, "b", 12, "m", 91.0, 90.2),
        quali(2024, 1, "solo", 3, "x", 80.0), *[quali(2024, 1, d, None, "three", 80.0) for d in ("c", "d", "e")],
        quali(2024, 1, "twice", 7, "same", 80.0), quali(2024, 1, "twice", 8, "same", 81.0),
        quali(2024, 1, "f", 9, "n"), quali(2024, 1, "g", None, "n")])
    got = pick(w.table("fct_teammate_qualifying"), "driver_id", "teammate_name", "session_compared",
               F.round("gap_seconds", 3), F.round("gap_pct", 4), "beat_teammate")
    assert got == {("a", "B", "Q2", -2.2, -2.5, True), ("b", "A", "Q2", 2.2, 2.5, False),
                   ("f", None, None, None, None, None), ("g", None, None, None, None, None)}
    assert pick(report.head_to_head(w.table), "driver_id", "head_to_head") == {
        ("a", "1–0"), ("b", "0–1"), ("f", "0–0"), ("g", "0–0")}
    assert pick(report.median_gap_percent(w.table), F.round("median_gap_pct", 5), driver_id="a") == {(-0.025,)}


# Laps ------------------------------------------------------------------------------------
def test_lap_zero_is_the_grid_of_races_with_laps(lake):
    lap = lambda d, n, p: {"season": 2010, "round": 1, "driver_id": d, "lap": n, "position": p, "lap_time_seconds": 90.0}
    w = lake(races=[race(2010, 1), race(2010, 2)], laps=[lap("a", 1, 1), lap("a", 2, None)],
             pit_stops=[{"season": 2010, "round": 1, "driver_id": "a", "lap": 1, "stop_number": n} for n in (1, 2)],
             results=[result(2010, 1, "a", 1, grid=2), result(2010, 1, "pits", 2, grid=0), result(2010, 1, "crash", 3, grid=3),
                      result(2010, 2, "a", 1, grid=1)])
    got = pick(w.table("fct_lap_positions"), "race_id", "driver_id", "lap", "position", "is_pit_lap")
    assert got == {(201001, "a", 1, 1, True), (201001, "a", 0, 2, False), (201001, "crash", 0, 3, False)}
    assert pick(report.lap_data_note(w.table), "race_id", "lap_data_note") == {
        (201001, None), (201002, "Lap-by-lap positions start in 1996")}


# Careers and streaks -----------------------------------------------------------------------
def test_streaks_run_over_own_starts(lake):
    finishes = {1: 1, 2: 1, 4: 1, 5: 3, 6: 1}  # round 3 missed
    w = lake(races=[race(2023, r) for r in range(1, 7)],
             results=[result(2023, r, "max", f, 25.0 if f == 1 else 0.0) for r, f in finishes.items()]
             + [result(2023, 5, "sergio", 1, 25.0)])
    got = pick(w.table("fct_driver_streaks"), "streak_type", "streak_length", "streak_rank", "first_race", "last_race_id",
               "runs_to_latest_start", driver_id="max")
    assert got == {
        ("win", 3, 1, "2023 GP 1", 202304, False), ("win", 1, 2, "2023 GP 6", 202306, True),
        ("podium", 5, 1, "2023 GP 1", 202306, True),
        ("points", 3, 1, "2023 GP 1", 202304, False), ("points", 1, 2, "2023 GP 6", 202306, True)}


def test_career_rates_and_ages(lake):
    w = lake(races=[race(2011, 5, DAY(2011, 5, 22)), race(2011, 6, DAY(2011, 6, 5))],
             results=[result(2011, 5, "ada", 1, 25.0, grid=4), result(2011, 6, "ada", 9, 0.0, text="R", grid=1)],
             drivers=[driver(2010, "ada", DAY(1990, 2, 10), driver_code="ADA", permanent_number=71),
                      driver(2011, "ada", DAY(1990, 2, 10), nationality="Norse")])
    got = pick(w.table("fct_driver_careers"), "starts", "wins", "win_rate", "pole_rate", "modern_points_per_start",
               "age_first_win", "age_last_win_days", "titles", "age_first_title")
    assert got == {(2, 1, 0.5, 0.5, 12.5, "21y 101d", 7771, 0, None)}
    assert pick(w.table("dim_driver"), "driver_code", "permanent_number", "nationality", "first_season", "seasons_entered") == {
        ("ADA", 71, "Norse", 2010, 2)}
    assert pick(report.age_record(w.table, "first_win", True), "holder") == {("Ada – 21y 101d",)}
    assert report.career_leaderboard(w.table).isEmpty()
    assert pick(report.career_leaderboard(w.table, minimum_starts=2), "driver_name") == {("Ada",)}


def test_constructor_keeps_its_latest_name_and_default_colours(lake):
    w = lake(results=[result(1994, 1, "a", 1, team="ferrari"), {**result(2000, 1, "a", 1, team="old"), "constructor_name": "Old"},
                      {**result(2001, 1, "a", 1, team="old"), "constructor_name": "New"}])
    assert pick(w.table("dim_constructor"), "constructor_id", "constructor_name", "team_colour", "text_colour") == {
        ("ferrari", "FERRARI", "#E8002D", "#FFFFFF"), ("old", "New", "#9E9E9E", "#000000")}


# Race weekend --------------------------------------------------------------------------------
def test_fastest_lap_card(lake):
    fast = {"fastest_lap_rank": 1, "fastest_lap_time": "1:32.608", "fastest_lap_number": 39}
    w = lake(races=[race(2024, r) for r in (1, 2, 3)], drivers=[driver(2024, "max"), driver(2024, "b")], results=[
        result(2024, 1, "max", 1, **fast), result(2024, 2, "max", 1), result(2024, 3, "max", 1, **fast), result(2024, 3, "b", 2, **fast)])
    assert pick(report.fastest_lap(w.table), "race_id", "fastest_lap") == {
        (202401, "Max – 1:32.608 (lap 39)"), (202402, "Fastest laps are recorded from 2004"), (202403, None)}
    assert pick(report.fastest_lap_highlight(w.table), "fastest_lap_highlight", race_id=202401) == {("#B138DD",)}


def test_finish_rank_is_dense_and_limits_the_chart(lake):
    w = lake(races=[race(2024, 1)], results=[
        result(2024, 1, "a", 1), result(2024, 1, "b", 2), result(2024, 1, "c", 2), result(2024, 1, "d", 7)])
    assert pick(report.finish_rank(w.table), "driver_id", "finish_rank") == {("a", 1), ("b", 2), ("c", 2), ("d", 3)}
    assert pick(report.leading_drivers(w.table, 2), "driver_id") == {("a",), ("b",), ("c",)}
    assert pick(report.show_driver(w.table, 2), "driver_id", show_driver=0) == {("d",)}
    unknown = lake(races=[race(2024, 1)], results=[result(2024, 1, d, f) for d, f in (("a", 1), ("b", 2), ("x", None))])
    assert pick(report.show_driver(unknown.table, 1), "driver_id", show_driver=1) == {("a",), ("x",)}
    assert pick(report.shown_drivers(unknown.table, 1), "driver_id") == {("a",), ("x",)}


def test_points_to_date_carry_over_a_missed_round(lake):
    w = lake(races=[race(2024, r) for r in (1, 2, 3, 4)], results=[
        result(2024, 1, "a", 1, 25.0), result(2024, 2, "b", 1, 25.0), result(2024, 3, "a", 2, 18.0)])
    assert pick(report.points_to_date(w.table), "round", "points_to_date", driver_id="a") == {(1, 25.0), (2, 25.0), (3, 43.0)}
    assert pick(report.points_to_date(w.table), "round", "points_to_date", driver_id="b") == {(1, None), (2, 25.0), (3, 25.0)}


# Assertions ---------------------------------------------------------------------------------
def test_a_sound_season_passes_every_assertion(lake, spark):
    grid = ["a", "b"]
    w = lake(
        races=[race(2024, 1), race(2024, 2)],
        results=[result(2024, r, d, p, 25.0 if p == 1 else 18.0, car=p, grid=p, team="ferrari", fastest_lap_rank=p,
                        fastest_lap_time="1:30.000", laps_completed=1) for r in (1, 2) for p, d in enumerate(grid, 1)],
        drivers=[driver(2024, d, DAY(1995, 1, 1)) for d in grid],
        qualifying=[quali(2024, r, d, p, "ferrari", 90.0 + p) for r in (1, 2) for p, d in enumerate(grid, 1)],
        driver_standings=[standing(2024, "a", 1, 50.0), standing(2024, "b", 2, 36.0)],
        laps=[{"season": 2024, "round": r, "driver_id": d, "lap": 1, "position": p} for r in (1, 2) for p, d in enumerate(grid, 1)],
        pit_stops=[{"season": 2024, "round": 1, "driver_id": "a", "lap": 1, "stop_number": 1}],
    )
    raw_laps = spark.createDataFrame([(2024, 1), (2024, 2)], "season int, round int")
    tables = lambda name: raw_laps if name == "raw_laps" else w.table(name)
    for name, (check, _) in ASSERTIONS.items():
        if name == "A16":  # these sessions have seconds but no text
            continue
        assert check(tables).isEmpty(), name

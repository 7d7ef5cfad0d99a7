import datetime as dt
import json

from pyspark.sql import functions as F

from apexlake.sources import staging

from conftest import rows

DRIVER = {"driverId": "ada", "permanentNumber": "71", "code": "ADA", "givenName": "Ada", "familyName": "Émile",
          "dateOfBirth": "1990-02-10", "nationality": "Norse", "url": "u"}
TEAM = {"constructorId": "red", "name": "Red", "nationality": "Austrian", "url": "u"}


def pages(spark, table, *contents, season=2024):
    """One raw page per content; the envelope's own season differs on purpose."""
    texts = [json.dumps({"MRData": {"limit": "100", "offset": "0", "total": "1", "xmlns": "", table: c}}) for c in contents]
    return spark.createDataFrame([(season, t) for t in texts], "season int, payload string")


def races(*entries):
    return {"season": "1900", "Races": list(entries)}


def test_results_cast_softly_and_keep_the_row(spark):
    winner = {"number": "1", "position": "1", "positionText": "1", "points": "26", "Driver": DRIVER, "Constructor": TEAM,
              "grid": "1", "laps": "61", "status": "Finished", "Time": {"millis": "5047315", "time": "1:24:07.315"},
              "FastestLap": {"rank": "1", "lap": "44", "Time": {"time": "1:29.513"}}}
    retired = {"number": "None", "position": "20", "positionText": "R", "points": "0", "Driver": DRIVER,
               "Constructor": TEAM, "grid": "0", "laps": "3", "status": "Engine"}
    got = staging.results(pages(spark, "RaceTable", races({"season": "1900", "round": "7", "Results": [winner, retired]})))
    first, second = got.orderBy("finish_position").collect()
    assert (first.season, first.round, first.driver_id, first.car_number, first.points) == (2024, 7, "ada", 1, 26.0)
    assert (first.race_time_millis, first.race_time, first.fastest_lap_seconds) == (5047315, "1:24:07.315", 89.513)
    assert first.fastest_lap_avg_speed is None
    assert (second.car_number, second.finish_position, second.finish_position_text) == (None, 20, "R")
    assert second.race_time is None and second.fastest_lap_rank is None


def test_a_race_split_over_two_pages_comes_back_whole(spark):
    entry = lambda n: {"number": n, "position": n, "positionText": n, "points": "0", "Driver": DRIVER, "Constructor": TEAM}
    got = staging.results(pages(
        spark, "RaceTable", races({"round": "1", "Results": [entry("1")]}),
        races({"round": "1", "Results": [entry("2")]}, {"round": "2", "Results": [entry("1")]})))
    assert rows(got.select("round", "finish_position")) == {(1, 1), (1, 2), (2, 1)}


def test_empty_and_unreadable_pages_give_no_rows(spark):
    broken = spark.createDataFrame([(2024, "{oops"), (2024, "")], "season int, payload string")
    assert staging.results(pages(spark, "RaceTable", races())).isEmpty()
    assert staging.results(broken).isEmpty()


def test_races_keep_a_date_without_a_time(spark):
    race = {"season": "2019", "round": "8", "raceName": "Harbour", "date": "2019-06-23", "time": "13:10:00Z",
            "Circuit": {"circuitId": "s", "circuitName": "S", "Location": {"lat": "52.1", "long": "-1.0", "locality": "x",
                                                                        "country": "UK"}},
            "Sprint": {"date": "2019-06-22"}, "url": "w"}
    row = staging.races(pages(spark, "RaceTable", races(race), season=2019)).first()
    assert row.race_start_utc == dt.datetime(2019, 6, 23, 13, 10) and row.circuit_latitude == 52.1
    assert (row.sprint_date, row.sprint_start_utc, row.fp1_date) == (dt.date(2019, 6, 22), None, None)


def test_qualifying_and_drivers(spark):
    entry = {"number": "1", "position": "2", "Driver": DRIVER, "Constructor": TEAM, "Q1": "1:18.250", "Q2": ""}
    row = staging.qualifying(pages(spark, "RaceTable", races({"round": "1", "QualifyingResults": [entry]}))).first()
    assert (row.q1_seconds, row.q2_seconds, row.q3_time, row.qualifying_position) == (78.25, None, None, 2)
    nameless = {"driverId": "x", "familyName": "Solo"}
    got = staging.drivers(pages(spark, "DriverTable", {"Drivers": [DRIVER, nameless]}))
    assert rows(got.select("driver_id", "full_name", "permanent_number")) == {("ada", "Ada Émile", 71), ("x", "Solo", None)}


def test_standings_keep_teams_as_an_array(spark):
    other = {"constructorId": "rb", "name": "RB"}
    entry = {"position": None, "positionText": "D", "points": "61", "wins": "4", "Driver": DRIVER, "Constructors": [TEAM, other]}
    content = {"StandingsLists": [{"season": "1995", "round": "14", "DriverStandings": [entry]}]}
    row = staging.driver_standings(pages(spark, "StandingsTable", content, season=1995)).first()
    assert (row.championship_position, row.championship_position_text, row.final_round) == (None, "D", 14)
    assert (row.constructor_ids, row.constructor_names) == (["red", "rb"], ["Red", "RB"])
    content = {"StandingsLists": [{"round": "14", "ConstructorStandings": [
        {"position": "1", "positionText": "1", "points": "100", "wins": "3", "Constructor": TEAM}]}]}
    team = staging.constructor_standings(pages(spark, "StandingsTable", content)).first()
    assert (team.constructor_id, team.championship_points) == ("red", 100.0)


def test_a_lap_split_over_two_pages(spark):
    lap = lambda driver, position: {"number": "1", "Timings": [{"driverId": driver, "position": position, "time": "1:21.466"}]}
    got = staging.laps(pages(
        spark, "RaceTable", races({"round": "1", "Laps": [lap("a", "1")]}), races({"round": "1", "Laps": [lap("b", None)]})))
    assert rows(got.select("lap", "driver_id", "position", F.round("lap_time_seconds", 3))) == {
        (1, "a", 1, 81.466), (1, "b", None, 81.466)}


def test_pit_stops_read_both_duration_forms(spark):
    stops = [{"driverId": "a", "lap": "5", "stop": "1", "time": "15:21:07", "duration": "23.915"},
             {"driverId": "a", "lap": "9", "stop": "2", "time": "15:33:40", "duration": "1:04.512"}]
    got = staging.pit_stops(pages(spark, "RaceTable", races({"round": "1", "PitStops": stops})))
    assert rows(got.select("stop_number", "lap", "duration_seconds")) == {(1, 5, 23.915), (2, 9, 64.512)}


def test_sprint(spark):
    entry = {"number": "71", "position": "1", "positionText": "1", "points": "3", "Driver": DRIVER, "Constructor": TEAM,
             "grid": "2", "laps": "19", "status": "Finished"}
    row = staging.sprint_results(pages(spark, "RaceTable", races({"round": "8", "SprintResults": [entry]}))).first()
    assert (row.round, row.points, row.grid_position, row.laps_completed) == (8, 3.0, 2, 19)

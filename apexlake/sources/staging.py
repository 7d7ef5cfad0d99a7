"""Staging: raw pages in, typed rows out.

Each model parses a page once with its explicit envelope schema, explodes the
nested rows and casts softly, so one bad value becomes a null for the checks
to count instead of failing the job. The season is the one the page was
requested under; the round comes from the payload. A race split over two pages
comes back together because every row is exploded on its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apexlake.functions.exprs import duration_seconds, session_start
from apexlake.sources.schemas import envelope


def _open(pages: DataFrame, endpoint: str, listing: str) -> DataFrame:
    """season and one ``outer`` struct per entry of the page's list.

    A plain explode makes Spark test the array for being empty first, in a
    filter of its own that parses every page a second time. The outer form
    parses once; the position tells an empty list from a null entry.
    """
    parsed = F.from_json("payload", envelope(endpoint))
    opened = pages.select("season", parsed.alias("page")).select(
        F.col("season").cast("int").alias("season"),
        F.posexplode_outer(f"page.MRData.{listing}").alias("place", "outer"),
    )
    return opened.where(F.col("place").isNotNull()).select("season", "outer")


def _rows(pages: DataFrame, endpoint: str, listing: str, detail: str) -> DataFrame:
    """season, round and one ``row`` struct per entry of the nested list."""
    return _open(pages, endpoint, listing).select(
        "season", _int("outer.round").alias("round"), F.explode(f"outer.{detail}").alias("row")
    )


def _int(path: str) -> Column:
    return F.col(path).try_cast("int")


def _double(path: str) -> Column:
    return F.col(path).try_cast("double")


def _date(path: str) -> Column:
    return F.col(path).try_cast("date")


def _text(path: str) -> Column:
    return F.col(path)


def _pick(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(*[column.alias(name) for name, column in columns.items()])


def races(pages: DataFrame) -> DataFrame:
    calendar = _open(pages, "races", "RaceTable.Races")

    def start(prefix: str) -> Column:
        return session_start(F.col(f"{prefix}.date"), F.col(f"{prefix}.time"))

    weekend = {
        "fp1": "FirstPractice", "fp2": "SecondPractice", "fp3": "ThirdPractice",
        "qualifying": "Qualifying", "sprint": "Sprint", "sprint_qualifying": "SprintQualifying",
    }
    return _pick(
        calendar,
        season=_text("season"), round=_int("outer.round"),
        race_name=_text("outer.raceName"), race_date=_date("outer.date"),
        race_start_utc=start("outer"),
        **{f"{name}_start_utc": start(f"outer.{key}") for name, key in weekend.items()},
        **{f"{name}_date": _date(f"outer.{key}.date") for name, key in weekend.items()},
        circuit_id=_text("outer.Circuit.circuitId"), circuit_name=_text("outer.Circuit.circuitName"),
        circuit_locality=_text("outer.Circuit.Location.locality"),
        circuit_country=_text("outer.Circuit.Location.country"),
        circuit_latitude=_double("outer.Circuit.Location.lat"),
        circuit_longitude=_double("outer.Circuit.Location.long"),
        wikipedia_url=_text("outer.url"),
    )


def results(pages: DataFrame) -> DataFrame:
    fastest = "row.FastestLap"
    return _pick(
        _rows(pages, "results", "RaceTable.Races", "Results"),
        season=_text("season"), round=_text("round"),
        driver_id=_text("row.Driver.driverId"),
        constructor_id=_text("row.Constructor.constructorId"),
        constructor_name=_text("row.Constructor.name"),
        constructor_nationality=_text("row.Constructor.nationality"),
        car_number=_int("row.number"), grid_position=_int("row.grid"),
        finish_position=_int("row.position"), finish_position_text=_text("row.positionText"),
        points=_double("row.points"), laps_completed=_int("row.laps"), status=_text("row.status"),
        race_time_millis=F.col("row.Time.millis").try_cast("bigint"), race_time=_text("row.Time.time"),
        fastest_lap_rank=_int(f"{fastest}.rank"), fastest_lap_number=_int(f"{fastest}.lap"),
        fastest_lap_time=_text(f"{fastest}.Time.time"),
        fastest_lap_seconds=duration_seconds(F.col(f"{fastest}.Time.time")),
        fastest_lap_avg_speed=_double(f"{fastest}.AverageSpeed.speed"),
        fastest_lap_avg_speed_units=_text(f"{fastest}.AverageSpeed.units"),
    )


def qualifying(pages: DataFrame) -> DataFrame:
    sessions = {}
    for name in ("Q1", "Q2", "Q3"):
        sessions[f"{name.lower()}_time"] = _text(f"row.{name}")
        sessions[f"{name.lower()}_seconds"] = duration_seconds(F.col(f"row.{name}"))
    return _pick(
        _rows(pages, "qualifying", "RaceTable.Races", "QualifyingResults"),
        season=_text("season"), round=_text("round"),
        driver_id=_text("row.Driver.driverId"),
        constructor_id=_text("row.Constructor.constructorId"),
        constructor_name=_text("row.Constructor.name"),
        car_number=_int("row.number"), qualifying_position=_int("row.position"),
        **sessions,
    )


def drivers(pages: DataFrame) -> DataFrame:
    return _pick(
        _open(pages, "drivers", "DriverTable.Drivers"),
        season=_text("season"), driver_id=_text("outer.driverId"),
        driver_code=_text("outer.code"), permanent_number=_int("outer.permanentNumber"),
        given_name=_text("outer.givenName"), family_name=_text("outer.familyName"),
        full_name=F.concat_ws(" ", "outer.givenName", "outer.familyName"),
        date_of_birth=_date("outer.dateOfBirth"), nationality=_text("outer.nationality"),
        wikipedia_url=_text("outer.url"),
    )


def _published(**own: Column) -> dict[str, Column]:
    return {
        **own,
        "championship_position": _int("row.position"),
        "championship_position_text": _text("row.positionText"),
        "championship_points": _double("row.points"),
        "wins": _int("row.wins"),
    }


def driver_standings(pages: DataFrame) -> DataFrame:
    return _pick(
        _rows(pages, "driver_standings", "StandingsTable.StandingsLists", "DriverStandings"),
        **_published(season=_text("season"), final_round=_text("round"), driver_id=_text("row.Driver.driverId")),
        constructor_ids=F.col("row.Constructors.constructorId"),
        constructor_names=F.col("row.Constructors.name"),
    )


def constructor_standings(pages: DataFrame) -> DataFrame:
    return _pick(
        _rows(pages, "constructor_standings", "StandingsTable.StandingsLists", "ConstructorStandings"),
        **_published(
            season=_text("season"), final_round=_text("round"),
            constructor_id=_text("row.Constructor.constructorId"),
            constructor_name=_text("row.Constructor.name"),
            constructor_nationality=_text("row.Constructor.nationality"),
        ),
    )


def laps(pages: DataFrame) -> DataFrame:
    timings = _rows(pages, "laps", "RaceTable.Races", "Laps").select(
        "season", "round", _int("row.number").alias("lap"), F.explode("row.Timings").alias("row")
    )
    return _pick(
        timings,
        season=_text("season"), round=_text("round"), lap=_text("lap"),
        driver_id=_text("row.driverId"), position=_int("row.position"),
        lap_time=_text("row.time"), lap_time_seconds=duration_seconds(F.col("row.time")),
    )


def pit_stops(pages: DataFrame) -> DataFrame:
    return _pick(
        _rows(pages, "pit_stops", "RaceTable.Races", "PitStops"),
        season=_text("season"), round=_text("round"), driver_id=_text("row.driverId"),
        stop_number=_int("row.stop"), lap=_int("row.lap"), time_of_day=_text("row.time"),
        duration=_text("row.duration"), duration_seconds=duration_seconds(F.col("row.duration")),
    )


def sprint_results(pages: DataFrame) -> DataFrame:
    return _pick(
        _rows(pages, "sprint", "RaceTable.Races", "SprintResults"),
        season=_text("season"), round=_text("round"),
        driver_id=_text("row.Driver.driverId"),
        constructor_id=_text("row.Constructor.constructorId"),
        constructor_name=_text("row.Constructor.name"),
        car_number=_int("row.number"), grid_position=_int("row.grid"),
        finish_position=_int("row.position"), finish_position_text=_text("row.positionText"),
        points=_double("row.points"), laps_completed=_int("row.laps"), status=_text("row.status"),
    )


# endpoint -> (staging table, model)
MODELS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "races": ("stg_races", races),
    "results": ("stg_results", results),
    "qualifying": ("stg_qualifying", qualifying),
    "drivers": ("stg_drivers", drivers),
    "driver_standings": ("stg_driver_standings", driver_standings),
    "constructor_standings": ("stg_constructor_standings", constructor_standings),
    "laps": ("stg_laps", laps),
    "pit_stops": ("stg_pit_stops", pit_stops),
    "sprint": ("stg_sprint_results", sprint_results),
}

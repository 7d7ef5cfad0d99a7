"""Explicit schemas: raw tables, the JSON payloads inside them, load state, seed.

Every payload field is a string because the API quotes every scalar; staging
casts once, softly. A field missing from a page becomes null.
"""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def struct(name: str, *fields: T.StructField) -> T.StructField:
    return T.StructField(name, T.StructType(list(fields)))


def rows(name: str, *fields: T.StructField) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.StructType(list(fields))))


# Shared pieces -----------------------------------------------------------
CIRCUIT = struct(
    "Circuit",
    *strings("circuitId", "url", "circuitName"),
    struct("Location", *strings("lat", "long", "locality", "country")),
)
DRIVER_FIELDS = strings(
    "driverId", "permanentNumber", "code", "url",
    "givenName", "familyName", "dateOfBirth", "nationality",
)
CONSTRUCTOR_FIELDS = strings("constructorId", "url", "name", "nationality")
DRIVER = struct("Driver", *DRIVER_FIELDS)
CONSTRUCTOR = struct("Constructor", *CONSTRUCTOR_FIELDS)
SESSIONS = ("FirstPractice", "SecondPractice", "ThirdPractice", "Qualifying", "Sprint", "SprintQualifying")
RACE_HEADER = [*strings("season", "round", "url", "raceName"), CIRCUIT, *strings("date", "time")]


def _race_table(*detail: T.StructField) -> T.StructField:
    return struct("RaceTable", rows("Races", *RACE_HEADER, *detail))


def _standings_table(detail: T.StructField) -> T.StructField:
    return struct("StandingsTable", rows("StandingsLists", *strings("season", "round"), detail))


# One entry per endpoint: what sits beside the paging fields in the envelope.
TABLES: dict[str, T.StructField] = {
    "races": _race_table(*[struct(s, *strings("date", "time")) for s in SESSIONS]),
    "results": _race_table(rows(
        "Results", *strings("number", "position", "positionText", "points"), DRIVER, CONSTRUCTOR,
        *strings("grid", "laps", "status"),
        struct("Time", *strings("millis", "time")),
        struct("FastestLap", *strings("rank", "lap"), struct("Time", *strings("time")),
               struct("AverageSpeed", *strings("units", "speed"))),
    )),
    "qualifying": _race_table(rows(
        "QualifyingResults", *strings("number", "position"), DRIVER, CONSTRUCTOR, *strings("Q1", "Q2", "Q3"),
    )),
    "drivers": struct("DriverTable", rows("Drivers", *DRIVER_FIELDS)),
    "driver_standings": _standings_table(rows(
        "DriverStandings", *strings("position", "positionText", "points", "wins"), DRIVER,
        rows("Constructors", *CONSTRUCTOR_FIELDS),
    )),
    "constructor_standings": _standings_table(rows(
        "ConstructorStandings", *strings("position", "positionText", "points", "wins"), CONSTRUCTOR,
    )),
    "laps": _race_table(rows(
        "Laps", *strings("number"), rows("Timings", *strings("driverId", "position", "time")),
    )),
    "pit_stops": _race_table(rows("PitStops", *strings("driverId", "lap", "stop", "time", "duration"))),
    "sprint": _race_table(rows(
        "SprintResults", *strings("number", "position", "positionText", "points"), DRIVER, CONSTRUCTOR,
        *strings("grid", "laps", "status"),
    )),
}


def envelope(endpoint: str) -> T.StructType:
    """Schema of a whole page: paging fields plus the endpoint's own table."""
    return T.StructType([struct("MRData", *strings("limit", "offset", "total"), TABLES[endpoint])])


# Paging fields alone, enough to check a page without reading its rows.
PAGING = T.StructType([struct("MRData", *strings("limit", "offset", "total"))])

SEASON_PAGE = T.StructType([
    T.StructField("season", T.IntegerType()),
    T.StructField("page_offset", T.IntegerType()),
    T.StructField("page_limit", T.IntegerType()),
    T.StructField("total_rows", T.IntegerType()),
    T.StructField("request_url", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
])
RACE_PAGE = T.StructType(
    [SEASON_PAGE["season"], T.StructField("round", T.IntegerType()), *SEASON_PAGE.fields[1:]]
)
LOAD_STATE = T.StructType([
    T.StructField("endpoint", T.StringType()),
    T.StructField("season", T.IntegerType()),
    T.StructField("last_round", T.IntegerType()),
    T.StructField("total_rows", T.IntegerType()),
    T.StructField("loaded_at", T.TimestampType()),
])
TEAM_COLOURS = T.StructType(strings("constructor_id", "team_colour", "text_colour"))

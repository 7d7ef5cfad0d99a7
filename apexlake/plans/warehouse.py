"""The models wired together. Every table is written once and read by its consumers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from apexlake.functions.exprs import season_of
from apexlake.operators.joins import measured_side
from apexlake.plans import checks
from apexlake.plans import intermediate as I
from apexlake.plans import marts as M
from apexlake.plans.quality import DECLARED
from apexlake.session import new_folder, write_at, write_once
from apexlake.sources import staging


@dataclass
class Rules:
    """Seasons in which the rules changed."""

    last_dropped_score_season: int = M.LAST_DROPPED_SCORE_SEASON
    aggregate_qualifying_season: int = M.AGGREGATE_QUALIFYING_SEASON
    first_knockout_season: int = M.FIRST_KNOCKOUT_SEASON


@dataclass
class Warehouse:
    """``raw`` maps endpoints to landed pages, ``logs`` to their landings; ``colours`` is the team colour seed.

    ``model`` plans a table over its written inputs, ``table`` writes it on
    first use and reads it from then on. The result joins have several
    consumers each, and staging would parse the JSON again for every one.
    """

    raw: Mapping[str, DataFrame]
    colours: DataFrame
    rules: Rules = field(default_factory=Rules)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    counted: dict[str, dict[str, int]] = field(default_factory=dict)
    stored: dict[str, DataFrame] = field(default_factory=dict)
    paths: dict[str, str] = field(default_factory=dict)
    logs: Mapping[str, DataFrame] = field(default_factory=dict)

    def model(self, name: str) -> DataFrame:
        return MODELS[name](self)

    def table(self, name: str) -> DataFrame:
        if name == "team_colours":
            return self.colours
        if name.startswith("raw_"):
            return self.raw[name.removeprefix("raw_")]
        if name not in self.tables:
            self._write(name)
        return self.tables[name]

    def _write(self, name: str) -> None:
        """Write a model, staging and race facts by season; what its checks need of the rows is counted meanwhile.

        Staging needs no shuffle before the write: raw pages lie in season folders, so a
        task reads few seasons, and a large season is read by many tasks.
        """
        model, counts = self.model(name), checks.measures(name, DECLARED)
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        rows = model.observe(seen, *[count.alias(label) for label, count in counts.items()]) if counts else model
        if name in RACE_FACTS:
            rows = rows.withColumn("season", season_of())
        by_season = name.startswith("stg_") or name in RACE_FACTS
        self.paths[name] = new_folder(rows.sparkSession, name)
        self.stored[name] = write_at(rows, self.paths[name], ("season",) if by_season else ())
        if counts:
            self.counted[name] = seen.get
        self.tables[name] = self.stored[name].select(*model.columns)

    def chosen(
        self, season: int | None = None, race_id: int | None = None, races: DataFrame | None = None,
    ) -> Callable[[str], DataFrame]:
        """Tables of a season, of a race, or of the ``race_id`` rows of a frame: what a report page shows.

        Race facts are stored by season, so only files of the seasons chosen are
        read. Tables by season keep the seasons of the races; the others stay whole.
        """
        if races is not None:
            picked = write_once(races.select("race_id").distinct(), "chosen-races")
            seasons = [row["season"] for row in picked.select(season_of().alias("season")).distinct().collect()]  # years
        else:
            seasons = [season if race_id is None else race_id // 100]

        def of(name: str) -> DataFrame:
            rows, columns = self.table(name), self.table(name).columns
            if name in RACE_FACTS:
                rows = self.stored[name] if self.stored.get(name) is not None else rows.withColumn("season", season_of())
            by_race = name in RACE_FACTS or name == "dim_race"
            if not by_race and name not in SEASON_TABLES:
                return rows
            found = rows.where(F.col("season").isin(seasons))
            if by_race and races is not None:
                found = found.join(measured_side(picked), "race_id", "left_semi")
            elif by_race and race_id is not None:
                found = found.where(F.col("race_id") == race_id)
            return found.select(*columns)

        return of

    def figures(self, name: str) -> dict[str, int] | None:
        """What was counted while a table was written; None for a table that came from elsewhere."""
        if name in MODELS:
            self.table(name)
        return self.counted.get(name)

    def staged(self) -> list[str]:
        return [table for table, _ in staging.MODELS.values()]

    def replaced(self, **tables: DataFrame) -> Warehouse:
        """The same warehouse with some tables exchanged; what depends on them is planned anew."""
        stale = {n for t in tables for n in _consumers(t)}
        kept = {n: df for n, df in self.tables.items() if n not in stale}

        def own(facts: dict) -> dict:
            return {n: fact for n, fact in facts.items() if n in kept and n not in tables}

        return Warehouse(
            self.raw, tables.get("team_colours", self.colours), self.rules, {**kept, **tables}, own(self.counted),
            own(self.stored), own(self.paths), self.logs)

    def publish(self, database: str, names: list[str] | None = None) -> None:
        """Enter written models in the catalogue where they lie, relations and columns with their descriptions.

        Staging and intermediate tables are read in place; nothing is copied.
        """
        for name in names or MODELS:
            self.table(name)
            rows = self.stored[name]
            columns = ", ".join(
                f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT '{_quoted(COLUMN_DESCRIPTIONS[f.name])}'" if f.name in COLUMN_DESCRIPTIONS else "")
                for f in rows.schema)
            by_season = name.startswith("stg_") or name in RACE_FACTS
            spark = rows.sparkSession
            spark.sql(
                f"CREATE TABLE {database}.{name} ({columns}) USING parquet {'PARTITIONED BY (season)' if by_season else ''} "
                f"COMMENT '{_quoted(DESCRIPTIONS[name])}' LOCATION '{self.paths[name]}'")
            if by_season:
                spark.catalog.recoverPartitions(f"{database}.{name}")

    def register_views(self, names: list[str] | None = None) -> None:
        """Expose models as temporary views."""
        for name in names or MODELS:
            self.table(name).createOrReplaceTempView(name)

    def save_marts(self, database: str) -> None:
        """Save the marts as tables, with the descriptions of the tables and their columns."""
        for name in MARTS:
            df = described(self.table(name), COLUMN_DESCRIPTIONS)
            df.write.mode("overwrite").saveAsTable(f"{database}.{name}")
            df.sparkSession.sql(f"COMMENT ON TABLE {database}.{name} IS '{_quoted(DESCRIPTIONS[name])}'")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def catalogued(spark: SparkSession, database: str) -> list[tuple[str, str, str | None, str | None]]:
    """Every column in a database as the catalogue has it: relation, its comment, column, its comment."""
    found = []
    for table in spark.catalog.listTables(database):
        if not table.isTemporary:
            columns = spark.catalog.listColumns(f"{database}.{table.name}")
            found += [(table.name, table.description, c.name, c.description) for c in columns]
    return found


def described(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """The same rows with a comment on every column that has one."""
    return df.select(*[
        F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c) for c in df.columns
    ])


def _staged(endpoint: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: staging.MODELS[endpoint][1](w.raw[endpoint])


MODELS: dict[str, Callable[[Warehouse], DataFrame]] = {
    **{table: _staged(endpoint) for endpoint, (table, _) in staging.MODELS.items()},
    "int_results_qualifying": lambda w: I.results_with_qualifying(
        w.table("stg_results"), w.table("stg_races"), w.table("stg_qualifying")),
    "int_driver_form": lambda w: I.driver_form(
        w.table("int_results_qualifying"), w.table("stg_sprint_results"), w.table("stg_races")),
    "int_driver_race": lambda w: I.driver_race(w.table("int_results_qualifying"), w.table("stg_drivers")),
    "int_teammate_qualifying": lambda w: I.teammate_qualifying(w.table("stg_qualifying")),
    "dim_season": lambda w: M.dim_season(
        w.table("stg_races"), w.table("stg_results"), w.table("stg_sprint_results"),
        w.table("stg_driver_standings"), w.rules.last_dropped_score_season),
    "dim_race": lambda w: M.dim_race(w.table("stg_races"), w.table("stg_results")),
    "dim_driver": lambda w: M.dim_driver(w.table("stg_drivers")),
    "dim_constructor": lambda w: M.dim_constructor(w.table("stg_results"), w.colours),
    "fct_race_results": lambda w: M.fct_race_results(w.table("int_results_qualifying")),
    "fct_points_by_round": lambda w: M.fct_points_by_round(w.table("int_driver_form")),
    "fct_driver_standings": lambda w: M.fct_driver_standings(
        w.table("stg_driver_standings"), w.table("int_results_qualifying"), w.table("stg_sprint_results"),
        w.table("int_driver_race"), w.table("dim_season")),
    "fct_driver_careers": lambda w: M.fct_driver_careers(
        w.table("int_driver_race"), w.table("dim_driver"), w.table("fct_driver_standings"), w.table("dim_season")),
    "fct_driver_streaks": lambda w: M.fct_driver_streaks(w.table("int_driver_race"), w.table("stg_races")),
    "fct_qualifying": lambda w: M.fct_qualifying(
        w.table("stg_qualifying"), w.table("int_results_qualifying"), w.table("stg_races"),
        w.rules.aggregate_qualifying_season, w.rules.first_knockout_season),
    "fct_lap_positions": lambda w: M.fct_lap_positions(
        w.table("stg_laps"), w.table("stg_pit_stops"), w.table("int_results_qualifying"), w.table("stg_races")),
    "fct_pit_stops": lambda w: M.fct_pit_stops(w.table("stg_pit_stops")),
    "fct_teammate_qualifying": lambda w: M.fct_teammate_qualifying(
        w.table("int_teammate_qualifying"), w.table("dim_driver")),
}
# Tables with a race key, stored by its season, and tables with one row or more a season.
RACE_FACTS = (
    "fct_race_results", "fct_points_by_round", "fct_qualifying", "fct_lap_positions", "fct_pit_stops", "fct_teammate_qualifying",
)
SEASON_TABLES = ("dim_season", "fct_driver_standings")
MARTS = [name for name in MODELS if name.startswith(("dim_", "fct_"))]

# Direct inputs of each model, used to know what to plan anew when one is exchanged.
INPUTS: dict[str, tuple[str, ...]] = {
    "int_results_qualifying": ("stg_results", "stg_races", "stg_qualifying"),
    "int_driver_form": ("int_results_qualifying", "stg_sprint_results", "stg_races"),
    "int_driver_race": ("int_results_qualifying", "stg_drivers"),
    "int_teammate_qualifying": ("stg_qualifying",),
    "dim_season": ("stg_races", "stg_results", "stg_sprint_results", "stg_driver_standings"),
    "dim_race": ("stg_races", "stg_results"),
    "dim_driver": ("stg_drivers",),
    "dim_constructor": ("stg_results", "team_colours"),
    "fct_race_results": ("int_results_qualifying",),
    "fct_points_by_round": ("int_driver_form",),
    "fct_driver_standings": (
        "stg_driver_standings", "int_results_qualifying", "stg_sprint_results", "int_driver_race", "dim_season"),
    "fct_driver_careers": ("int_driver_race", "dim_driver", "fct_driver_standings", "dim_season"),
    "fct_driver_streaks": ("int_driver_race", "stg_races"),
    "fct_qualifying": ("stg_qualifying", "int_results_qualifying", "stg_races"),
    "fct_lap_positions": ("stg_laps", "stg_pit_stops", "int_results_qualifying", "stg_races"),
    "fct_pit_stops": ("stg_pit_stops",),
    "fct_teammate_qualifying": ("int_teammate_qualifying", "dim_driver"),
}


def _consumers(name: str) -> set[str]:
    direct = {model for model, inputs in INPUTS.items() if name in inputs}
    return direct.union(*[_consumers(model) for model in direct]) if direct else set()


DESCRIPTIONS = {
    "stg_races": "One row per race on the calendar, as published.",
    "stg_results": "One row per driver, car and race, as published.",
    "stg_qualifying": "One row per driver and qualifying session.",
    "stg_drivers": "One row per driver and season entered.",
    "stg_driver_standings": "One row per driver in the final standings of a season.",
    "stg_constructor_standings": "One row per team in the final standings of a season.",
    "stg_laps": "One row per driver and lap.",
    "stg_pit_stops": "One row per pit stop, as published.",
    "stg_sprint_results": "One row per driver and sprint.",
    "int_results_qualifying": "Race results beside qualifying: one row per driver, car and race.",
    "int_driver_form": "One row per driver and race with points to date and over five races.",
    "int_driver_race": "One row per driver and race, cars taken together, with era-neutral points.",
    "int_teammate_qualifying": "One row per driver, race and teammate in teams of two.",
    "dim_season": "One row per season: races and sprints scheduled and run, title margin.",
    "dim_race": "One row per race on the calendar, run or not.",
    "dim_driver": "One row per driver with the latest known attributes.",
    "dim_constructor": "One row per team with its latest name and its colours.",
    "fct_race_results": "One row per driver, car and race.",
    "fct_points_by_round": "One row per driver and race: race and sprint points with form.",
    "fct_driver_standings": "One row per driver and season: published title points beside points scored.",
    "fct_driver_careers": "One row per driver: totals, rates, ages at first and last successes.",
    "fct_driver_streaks": "One row per unbroken run of wins, podiums or points finishes.",
    "fct_qualifying": "One row per driver and qualifying session with the gap in the last session timed.",
    "fct_lap_positions": "One row per driver and lap; lap 0 is the grid.",
    "fct_pit_stops": "One row per pit stop.",
    "fct_teammate_qualifying": "One row per driver and qualifying session against the teammate.",
}

COLUMN_DESCRIPTIONS = {
    "stg_races": "One row per race on the calendar, as published.",
    "stg_results": "One row per driver, car and race, as published.",
    "stg_qualifying": "One row per driver and qualifying session.",
    "stg_drivers": "One row per driver and season entered.",
    "stg_driver_standings": "One row per driver in the final standings of a season.",
    "stg_constructor_standings": "One row per team in the final standings of a season.",
    "stg_laps": "One row per driver and lap.",
    "stg_pit_stops": "One row per pit stop, as published.",
    "stg_sprint_results": "One row per driver and sprint.",
    "int_results_qualifying": "Race results beside qualifying: one row per driver, car and race.",
    "int_driver_form": "One row per driver and race with points to date and over five races.",
    "int_driver_race": "One row per driver and race, cars taken together, with era-neutral points.",
    "int_teammate_qualifying": "One row per driver, race and teammate in teams of two.",
    "race_id": "season * 100 + round",
    "car_number": "Number the car raced under; a driver can have two in one race.",
    "was_classified": "The result text is a number; a retirement keeps a numeric finish position.",
    "grid_position": "Starting slot; 0 is a pit-lane start.",
    "positions_gained": "Grid minus finish; null for pit-lane starts and retirements.",
    "grid_penalty_positions": "Grid minus qualifying position.",
    "is_fastest_lap": "False, not null, where no ranking was recorded.",
    "points_in_previous_5_races": "Form before the race itself; null at a first entry.",
    "championship_points": "As published, after dropped scores.",
    "points_scored": "Races and sprints, nothing dropped.",
    "points_dropped": "Published minus scored: zero or negative.",
    "is_champion": "First in the standings of a finished season.",
    "title_margin": "First minus second; the current lead while a season runs.",
    "modern_points": "Points on the scale of today, without sprints and fastest laps.",
    "streak_rank": "Rank by length within the kind of streak; ties share a rank.",
    "runs_to_latest_start": "The streak includes the latest start of the driver.",
    "gap_seconds": "Behind the best in the same session; between teammates, negative is faster.",
    "gap_pct": "Gap as a percentage of the faster time.",
    "is_pit_lap": "The driver stopped on this lap; false where stops are not recorded.",
    "team_colour": "Hex colour; grey for teams without one.",
}

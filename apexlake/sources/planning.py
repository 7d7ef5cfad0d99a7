"""What to load next, and what has been loaded: plans and watermarks as tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from apexlake.sources.landing import highest_round
from apexlake.sources.schemas import LOAD_STATE
from apexlake.session import read_if_there, remove

FIRST_SEASON = 1950

# The endpoints, the season each one starts in, and whether it is
# fetched race by race.
ENDPOINTS = (
    ("races", "races", 1950, False),
    ("results", "results", 1950, False),
    ("qualifying", "qualifying", 1994, False),
    ("drivers", "drivers", 1950, False),
    ("driver_standings", "driverStandings", 1950, False),
    ("constructor_standings", "constructorStandings", 1958, False),
    ("sprint", "sprint", 2021, False),
    ("laps", "laps", 1996, True),
    ("pit_stops", "pitstops", 2011, True),
)
PER_RACE = frozenset(name for name, _, _, per_race in ENDPOINTS if per_race)
PROGRESS_SUFFIX = "_progress"


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ENDPOINTS, "endpoint string, path string, first_season int, per_race boolean")


def season_spine(spark: SparkSession, first: int | None, last: int) -> DataFrame:
    """Every season of an inclusive range. A reversed range is an error, not an empty plan."""
    start = FIRST_SEASON if first is None else first
    if last < start:
        raise ValueError(f"season range {start}-{last} ends before it starts")
    return spark.range(start, last + 1).select(F.col("id").cast("int").alias("season"))


def coverage(seasons: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Season and endpoint wherever the source carries data (nine endpoints: broadcast)."""
    return seasons.join(F.broadcast(endpoints), F.col("season") >= F.col("first_season")).select(
        "season", "endpoint", "per_race"
    )


def latest_completed_race(results: DataFrame) -> DataFrame:
    """Season and round of the newest race with results: one row."""
    newest = results.agg(F.max(F.struct("season", "round")).alias("newest"))
    return newest.select("newest.season", F.col("newest.round").alias("latest_round"))


def season_calendar(races: DataFrame) -> DataFrame:
    """All rounds on the calendar, in order, including those not run yet."""
    return races.select("season", "round").distinct().orderBy("season", "round")


def load_plan(covered: DataFrame, state: DataFrame, latest: DataFrame, force: bool = False) -> DataFrame:
    """Endpoint seasons to fetch.

    Never loaded: fetch. Loaded and settled (no row in ``latest``): skip.
    Loaded and still running: fetch when a newer round has been completed, or
    when the watermark names no round. Returning the plan without running it is
    the dry run. Give ``latest`` a row for last season too and the races that
    came after its last load are picked up once a new season has begun.
    """
    known = state.select("endpoint", "season", "last_round", F.lit(True).alias("loaded"))
    joined = covered.join(known, ["endpoint", "season"], "left").join(latest, "season", "left")
    due = F.col("latest_round").isNotNull() & (
        F.col("last_round").isNull() | (F.col("latest_round") > F.col("last_round"))
    )
    return joined.where(F.lit(force) | F.col("loaded").isNull() | due).select("season", "endpoint")


def resume_plan(calendar: DataFrame, state: DataFrame, latest: DataFrame, endpoint: str, force: bool = False) -> DataFrame:
    """Rounds still to fetch for an endpoint loaded race by race.

    Starts after the furthest round either watermark names and stops at the
    newest completed one. Forcing starts at the first round.
    """
    own = state.where(F.col("endpoint").isin(endpoint, endpoint + PROGRESS_SUFFIX))
    done = own.groupBy("season").agg(F.max("last_round").alias("loaded_through"))
    through = F.lit(0) if force else F.coalesce("loaded_through", F.lit(0))
    return (
        calendar.select("season", "round").distinct()
        .join(done, "season", "left").join(latest, "season", "left")
        .where((F.col("round") > through) & (F.col("round") <= F.coalesce("latest_round", F.col("round"))))
        .select("season", "round")
    )


def round_outcomes(planned: DataFrame, pages: DataFrame, latest: DataFrame) -> DataFrame:
    """What became of each planned round: ``landed``, ``absent`` or ``unpublished``.

    The newest round on the calendar of a running season, if it has no pages,
    has not been published yet and is tried again. Any other empty round is a
    race without data, whatever became of the rounds after it.
    """
    landed = pages.groupBy("season", "round").agg(
        F.count("*").alias("page_count"), F.min_by("total_rows", "page_offset").alias("total_rows")
    )
    waiting = F.coalesce(F.col("round") == F.col("latest_round"), F.lit(False))
    return (
        planned.join(landed, ["season", "round"], "left").join(latest, "season", "left")
        .withColumn(
            "outcome",
            F.when(F.col("page_count") > 0, "landed").when(waiting, "unpublished").otherwise("absent"),
        )
        .select("season", "round", F.coalesce("total_rows", F.lit(0)).alias("total_rows"), "outcome")
    )


def season_watermarks(endpoint: str, requested: DataFrame, pages: DataFrame, latest: DataFrame) -> DataFrame:
    """Watermarks of whole-season loads.

    The round completed at loading time wins over the rounds in the payload:
    drivers name none, and the calendar names rounds still to come. A season
    without pages is recorded with no rows.
    """
    named = F.col("payload_round") if "payload_round" in pages.columns else highest_round(F.col("payload"))
    loaded = pages.groupBy("season").agg(
        F.max(named).alias("payload_round"),
        F.min_by("total_rows", "page_offset").alias("total_rows"),
    )
    return (
        requested.select("season").distinct().join(loaded, "season", "left").join(latest, "season", "left")
        .select(
            F.lit(endpoint).alias("endpoint"), "season",
            F.coalesce("latest_round", "payload_round").alias("last_round"),
            F.coalesce("total_rows", F.lit(0)).alias("total_rows"),
        )
    )


def race_progress(endpoint: str, outcomes: DataFrame) -> DataFrame:
    """Progress after every round with a running total of rows, up to an unpublished round.

    At most 99 rounds share a window partition.
    """
    so_far = Window.partitionBy("season").orderBy("round")
    return outcomes.where(F.col("outcome") != "unpublished").select(
        F.lit(endpoint + PROGRESS_SUFFIX).alias("endpoint"), "season", F.col("round").alias("last_round"),
        F.sum("total_rows").over(so_far).cast("int").alias("total_rows"),
    )


def race_watermarks(endpoint: str, outcomes: DataFrame) -> DataFrame:
    """Watermarks after a race-by-race load: progress always, completion when nothing is open.

    Totals are recomputed from everything landed for the season, so a resumed
    load does not restart its count.
    """
    progress = race_progress(endpoint, outcomes)
    newest = progress.groupBy("endpoint", "season").agg(
        F.max("last_round").alias("last_round"), F.max_by("total_rows", "last_round").alias("total_rows")
    )
    open_seasons = outcomes.where(F.col("outcome") == "unpublished").select("season").distinct()
    complete = newest.join(open_seasons, "season", "left_anti").select(
        F.lit(endpoint).alias("endpoint"), "season", "last_round", "total_rows"
    )
    return newest.select("endpoint", "season", "last_round", "total_rows").unionByName(complete)


def upsert_watermarks(state: DataFrame, fresh: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """State with the fresh rows in place of the old ones of the same endpoint and season."""
    stamped = fresh.withColumn("loaded_at", loaded_at if loaded_at is not None else F.current_timestamp())
    kept = state.join(stamped, ["endpoint", "season"], "left_anti")
    return kept.select(*LOAD_STATE.names).unionByName(stamped.select(*LOAD_STATE.names))


def run_summary(loaded: DataFrame, failures: DataFrame) -> DataFrame:
    """One row describing a run. Its lists hold endpoint seasons, nine per year at most."""
    name = F.concat_ws(" ", "season", "endpoint")
    done = loaded.agg(
        F.count("*").alias("loaded"), F.coalesce(F.sum("total_rows"), F.lit(0)).alias("source_rows"),
        F.sort_array(F.collect_list(name)).alias("endpoint_seasons"),
    )
    failed = failures.agg(
        F.sort_array(F.collect_list(F.concat(name, F.lit(": "), "reason"))).alias("failures")
    )
    return done.crossJoin(F.broadcast(failed))  # one row each


@dataclass
class LoadState:
    """The watermark table: every write adds lines of its own, the newest line of an endpoint season counts.

    Each write has its own folder, so loads that run side by side neither
    overwrite nor disturb one another.
    """

    spark: SparkSession
    path: str

    def _lines(self) -> DataFrame | None:
        return read_if_there(self.spark, LOAD_STATE, self.path)

    def read(self, missing_ok: bool = False) -> DataFrame:
        """Current watermarks. A missing table counts as empty only where asked for (a dry run)."""
        lines = self._lines()
        if lines is None:
            if missing_ok:
                return self.spark.createDataFrame([], LOAD_STATE)
            raise FileNotFoundError(f"no load state at {self.path}")
        order = F.struct("loaded_at", "last_round", "total_rows")
        newest = lines.groupBy("endpoint", "season").agg(F.max_by(F.struct(*LOAD_STATE.names[2:]), order).alias("line"))
        return newest.select("endpoint", "season", "line.*")

    def _append(self, lines: DataFrame) -> None:
        lines.select(*LOAD_STATE.names).write.parquet(f"{self.path}/write={uuid.uuid4().hex}")

    def create(self) -> None:
        if self._lines() is None:
            self._append(self.spark.createDataFrame([], LOAD_STATE))

    def upsert(self, fresh: DataFrame) -> DataFrame:
        self._append(fresh.withColumn("loaded_at", F.current_timestamp()))
        return self.read()

    def compact(self) -> None:
        """Replace all lines by the current ones. Not while loads are running."""
        old = self._lines()
        if old is not None:
            folders = {name.rsplit("/", 1)[0] for name in old.inputFiles()}  # one per write
            self._append(self.read())
            for folder in folders:
                remove(self.spark, folder)

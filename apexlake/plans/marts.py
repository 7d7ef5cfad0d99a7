"""The star schema: four dimensions and nine facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apexlake.functions import exprs as X
from apexlake.operators.gaps import group_gap
from apexlake.operators.grouping import accumulate, collapse, latest_attributes
from apexlake.operators.joins import calendar_rows, small_side
from apexlake.operators.ranking import rank_by_histogram
from apexlake.operators.sequences import islands

RACE = ["season", "round"]
DRIVER_RACE = ["season", "round", "driver_id"]
DRIVER_SEASON = ["season", "driver_id"]

# Rule changes the models depend on.
LAST_DROPPED_SCORE_SEASON = 1990
AGGREGATE_QUALIFYING_SEASON = 2005
FIRST_KNOCKOUT_SEASON = 2006


# Dimensions --------------------------------------------------------------
def dim_season(
    races: DataFrame, results: DataFrame, sprints: DataFrame, standings: DataFrame,
    last_dropped_score_season: int = LAST_DROPPED_SCORE_SEASON,
) -> DataFrame:
    """M1. The margin of a season still running is the leader's current lead."""
    # Races found in the facts may be missing from the calendar, so its size bounds neither: no hint, AQE decides.
    ran = results.select(*RACE).distinct().withColumn("ran", F.lit(1))
    sprinted = sprints.select(*RACE).distinct().withColumn("sprinted", F.lit(1))
    calendar = (
        races.select(*RACE, "race_date", "sprint_date")
        .join(ran, RACE, "left")
        .join(sprinted, RACE, "left")
    )
    seasons = collapse(
        calendar, ["season"],
        races_scheduled=F.count("*"), races_completed=F.count("ran"),
        sprint_weekends_scheduled=F.count("sprint_date"), sprints_completed=F.count("sprinted"),
        first_race_date=F.min("race_date"), last_race_date=F.max("race_date"),
    )
    newest = races.agg(F.max("season").alias("newest_season"))

    def points_of(place: int):
        return F.max(F.when(F.col("championship_position") == place, F.col("championship_points")))

    margins = collapse(standings, ["season"], title_margin=points_of(1) - points_of(2))
    return (
        seasons.crossJoin(F.broadcast(newest))  # one row
        .join(margins, "season", "left")
        .select(
            "season", "races_scheduled", "races_completed", "sprint_weekends_scheduled", "sprints_completed",
            "first_race_date", "last_race_date",
            (F.col("season") <= last_dropped_score_season).alias("is_dropped_scores_era"),
            (F.col("season") == F.col("newest_season")).alias("is_current_season"),
            "title_margin",
        )
    )


def dim_race(races: DataFrame, results: DataFrame) -> DataFrame:
    """M2. The calendar with rounds still to come; only completed ones have results."""
    ran = results.select(*RACE).distinct().withColumn("has_results", F.lit(True))
    return races.join(ran, RACE, "left").select(
        X.race_id().alias("race_id"), *RACE, "race_name",
        X.race_label(F.col("round"), F.col("race_name")).alias("race_label"),
        "race_date", "race_start_utc", "circuit_id", "circuit_name", "circuit_locality", "circuit_country",
        "circuit_latitude", "circuit_longitude",
        X.flag(F.col("has_results")).alias("has_results"),
        F.col("sprint_date").isNotNull().alias("is_sprint_weekend"),
        "wikipedia_url",
    )


def dim_driver(drivers: DataFrame) -> DataFrame:
    """M3. Latest attributes; code and number keep the last known value."""
    same = ["given_name", "family_name", "date_of_birth", "nationality", "wikipedia_url"]
    latest = latest_attributes(
        drivers, "driver_id", ["season"],
        {"driver_name": "full_name", **{c: c for c in same}},
        when_known={"driver_code": "driver_code", "permanent_number": "permanent_number"},
        first_season=F.min("season"), last_season=F.max("season"), seasons_entered=F.count("*"),
    )
    return latest.select(
        "driver_id", "driver_name", "given_name", "family_name", "driver_code", "permanent_number",
        "date_of_birth", "nationality", "wikipedia_url", "first_season", "last_season", "seasons_entered",
    )


def dim_constructor(results: DataFrame, colours: DataFrame) -> DataFrame:
    """M4. From the results, because the first teams never had a championship of their own."""
    teams = latest_attributes(
        results, "constructor_id", ["season", "round", "constructor_name"],
        {"constructor_name": "constructor_name", "constructor_nationality": "constructor_nationality"},
        first_season=F.min("season"), last_season=F.max("season"),
    )
    return teams.join(colours, "constructor_id", "left").select(
        "constructor_id", "constructor_name", "constructor_nationality", "first_season", "last_season",
        F.coalesce("team_colour", F.lit(X.DEFAULT_TEAM_COLOUR)).alias("team_colour"),
        F.coalesce("text_colour", F.lit(X.DEFAULT_TEXT_COLOUR)).alias("text_colour"),
    )


# Facts -------------------------------------------------------------------
def fct_race_results(joined: DataFrame) -> DataFrame:
    """M5. A retirement keeps a numeric position, so wins and podiums ask for classification."""
    classified, finish = F.col("was_classified"), F.col("finish_position")
    return joined.select(
        X.race_id().alias("race_id"), "driver_id", "constructor_id", "car_number",
        "qualifying_position", "best_qualifying_seconds", "grid_position", "finish_position",
        "finish_position_text", "was_classified", "status", "laps_completed", "points", "race_time_millis",
        "fastest_lap_time", "fastest_lap_number", "fastest_lap_seconds",
        "positions_gained", "grid_penalty_positions",
        (classified & (finish == 1)).alias("is_win"),
        (classified & (finish <= 3)).alias("is_podium"),
        (F.col("points") > 0).alias("scored_points"),
        X.flag(F.col("fastest_lap_rank") == 1).alias("is_fastest_lap"),
    )


def fct_points_by_round(form: DataFrame) -> DataFrame:
    """M6."""
    return form.select(
        X.race_id().alias("race_id"), "driver_id", "race_points", "sprint_points",
        F.col("points").alias("total_points"), "best_finish_position", "was_classified",
        "career_races_to_date", "career_points_to_date", "career_wins_to_date",
        "points_last_5_races", "avg_finish_last_5_races", "points_in_previous_5_races",
    )


def fct_driver_standings(
    standings: DataFrame, joined: DataFrame, sprints: DataFrame, starts: DataFrame, seasons: DataFrame
) -> DataFrame:
    """M7. The published championship beside what was scored on track.

    Cars, sprints and starts are stacked and aggregated in one shuffle. Wins,
    podiums and retirements count cars; poles and era-neutral points count
    starts. A driver without any car that season has no race statistics.
    """
    classified, finish = F.col("was_classified"), F.col("finish_position")
    cars = joined.select(
        *DRIVER_SEASON, F.col("points").alias("car_points"),
        F.lit(1).alias("car"),
        X.as_count(classified & (finish == 1)).alias("win"),
        X.as_count(classified & (finish <= 3)).alias("on_podium"),
        X.as_count(~classified).alias("retired"),
        F.when(classified, finish).alias("classified_finish"),
        "grid_position", "positions_gained",
    )
    per_start = starts.select(
        *DRIVER_SEASON, F.lit(1).alias("start"), X.as_count(F.col("pole")).alias("pole"), "modern_points"
    )
    sprint = sprints.select(*DRIVER_SEASON, F.col("points").alias("sprint_points"))
    scored = accumulate(
        [cars, per_start, sprint], DRIVER_SEASON,
        cars=F.count("car"), entered=F.count("start"),
        race_wins=F.sum("win"), podiums=F.sum("on_podium"), did_not_finish=F.sum("retired"),
        race_total=F.sum("car_points"), sprint_total=F.sum("sprint_points"),
        avg_finish=F.avg("classified_finish"), avg_grid=F.avg("grid_position"),
        net_positions_gained=F.sum("positions_gained"),
        pole_total=F.sum("pole"), modern_total=F.sum("modern_points"),
    )
    finished = seasons.select("season", (F.col("races_completed") == F.col("races_scheduled")).alias("is_finished"))
    race_points = F.coalesce("race_total", F.lit(0.0))
    sprint_points = F.coalesce("sprint_total", F.lit(0.0))
    return (
        standings.join(scored, DRIVER_SEASON, "left")
        .join(small_side(finished, calendar_rows(seasons)), "season", "left")
        .select(
            *DRIVER_SEASON, X.joined(F.col("constructor_names")).alias("constructor_names"),
            "championship_position", "championship_position_text", "championship_points",
            F.col("wins").alias("championship_wins"),
            X.flag((F.col("championship_position") == 1) & F.col("is_finished")).alias("is_champion"),
            (race_points + sprint_points).alias("points_scored"),
            race_points.alias("race_points_scored"), sprint_points.alias("sprint_points_scored"),
            (F.col("championship_points") - (race_points + sprint_points)).alias("points_dropped"),
            F.when(F.col("cars") > 0, F.col("entered")).alias("races_entered"), "race_wins", "podiums",
            F.coalesce("pole_total", F.lit(0)).alias("poles"),
            F.coalesce("modern_total", F.lit(0)).alias("modern_points"),
            "did_not_finish",
            F.round("avg_finish", 2).alias("avg_finish_position"),
            F.round("avg_grid", 2).alias("avg_grid_position"),
            "net_positions_gained",
        )
    )


def fct_driver_careers(starts: DataFrame, drivers: DataFrame, standings: DataFrame, seasons: DataFrame) -> DataFrame:
    """M8. Totals, rates, the era-neutral score and the ages at first and last successes."""
    finales = collapse(starts, ["season"], final_race_date=F.max("race_date"))
    champions = standings.where("is_champion").select("season", "driver_id")
    titles = collapse(
        champions.join(finales, "season"), ["driver_id"],
        titles=F.count("*"),
        first_title_date=F.min("final_race_date"), last_title_date=F.max("final_race_date"),
        first_title_season=F.min("season"), last_title_season=F.max("season"),
    )

    def date_of(edge, name: str):
        return edge(F.when(F.col(name), F.col("race_date")))

    careers = collapse(
        starts, ["driver_id"],
        first_season=F.min("season"), last_season=F.max("season"), starts=F.count("*"),
        wins=F.count_if("won"), podiums=F.count_if("podium"), poles=F.count_if("pole"),
        points_finishes=F.count_if("scored_points"), modern_points=F.sum("modern_points"),
        first_win_date=date_of(F.min, "won"), last_win_date=date_of(F.max, "won"),
        first_podium_date=date_of(F.min, "podium"), last_podium_date=date_of(F.max, "podium"),
    )
    milestones = ["first_win", "last_win", "first_podium", "last_podium", "first_title", "last_title"]
    born = F.col("date_of_birth")
    return (
        careers.join(titles, "driver_id", "left")
        .join(drivers.select("driver_id", "date_of_birth"), "driver_id", "left")
        .select(
            "driver_id", "first_season", "last_season", "starts", "wins", "podiums", "poles", "points_finishes",
            F.coalesce("titles", F.lit(0)).alias("titles"),
            (F.col("wins") / F.col("starts")).alias("win_rate"),
            (F.col("podiums") / F.col("starts")).alias("podium_rate"),
            (F.col("poles") / F.col("starts")).alias("pole_rate"),
            "modern_points", (F.col("modern_points") / F.col("starts")).alias("modern_points_per_start"),
            "first_win_date", "last_win_date", "first_podium_date", "last_podium_date",
            "first_title_season", "last_title_season",
            *[F.datediff(f"{m}_date", born).alias(f"age_{m}_days") for m in milestones],
            *[X.age_label(F.col(f"{m}_date"), born).alias(f"age_{m}") for m in milestones],
        )
    )


def fct_driver_streaks(starts: DataFrame, races: DataFrame) -> DataFrame:
    """M9. Unbroken runs of wins, podiums and points finishes over a driver's own starts."""
    rounds = calendar_rows(races)
    runs = islands(
        starts, "driver_id", ["race_date", "race_id"],
        {"win": "won", "podium": "podium", "points": "scored_points"}, keep=["race_id", "race_date"],
    ).withColumnRenamed("run_type", "streak_type")
    streaks = collapse(
        runs, ["driver_id", "streak_type", "run"],
        streak_length=F.count("*"),
        first_race_id=F.min_by("race_id", "position"), last_race_id=F.max_by("race_id", "position"),
        first_race_date=F.min("race_date"), last_race_date=F.max("race_date"),
        runs_to_latest_start=F.max("is_newest"),
    )
    ranked = rank_by_histogram(streaks, "streak_type", "streak_length", "streak_rank", distinct_values=3 * rounds)

    def label(edge: str) -> DataFrame:
        names = races.select(
            X.race_id().alias(f"{edge}_race_id"), F.concat("season", F.lit(" "), "race_name").alias(f"{edge}_race")
        )
        return small_side(names, rounds)

    return (
        ranked.join(label("first"), "first_race_id", "left")
        .join(label("last"), "last_race_id", "left")
        .select(
            "driver_id", "streak_type", "streak_length", "streak_rank", "first_race_id", "last_race_id",
            "first_race_date", "last_race_date", "first_race", "last_race", "runs_to_latest_start",
        )
    )


def fct_qualifying(
    qualifying: DataFrame, joined: DataFrame, races: DataFrame,
    aggregate_season: int = AGGREGATE_QUALIFYING_SEASON, first_knockout_season: int = FIRST_KNOCKOUT_SEASON,
) -> DataFrame:
    """M10. The gap is taken within the last session a driver set a time in.

    In the aggregate season a driver with two laps is measured on their sum.
    Session names are knockout rounds only from the first knockout season.
    """
    q1, q2, q3 = (F.col(f"q{n}_seconds") for n in (1, 2, 3))
    # A missing lap makes the sum null; then the usual order applies.
    summed = F.when(F.col("season") == aggregate_season, q1 + q2)
    session = F.coalesce(
        F.when(summed.isNotNull(), F.lit("Aggregate")),
        *[F.when(t.isNotNull(), F.lit(n)) for n, t in (("Q3", q3), ("Q2", q2), ("Q1", q1))],
    )
    timed = qualifying.withColumns({
        "best_qualifying_seconds": X.best_time(q1, q2, q3),
        "final_session_seconds": F.coalesce(summed, q3, q2, q1),
        "timed_session": session,
    })
    with_gap = group_gap(
        timed, [*RACE, "timed_session"], "final_session_seconds", "gap_seconds", groups=5 * calendar_rows(races)
    )
    grid = collapse(joined, DRIVER_RACE, grid_position=F.min("grid_position"))
    return with_gap.join(grid, DRIVER_RACE, "left").select(
        X.race_id().alias("race_id"), "driver_id", "constructor_id", "qualifying_position",
        "q1_time", "q2_time", "q3_time", "q1_seconds", "q2_seconds", "q3_seconds",
        "best_qualifying_seconds", "final_session_seconds", "gap_seconds",
        F.when(F.col("season") >= first_knockout_season, F.col("timed_session")).alias("final_session"),
        "grid_position",
    )


def fct_lap_positions(laps: DataFrame, pit_stops: DataFrame, joined: DataFrame, races: DataFrame) -> DataFrame:
    """M11. Laps with a recorded position, and lap 0 from the grid of every race that has laps."""
    lap_key = [*DRIVER_RACE, "lap"]
    stopped = pit_stops.select(*lap_key).distinct().withColumn("stopped", F.lit(True))
    driven = laps.where(F.col("position").isNotNull()).join(stopped, lap_key, "left").select(
        X.race_id().alias("race_id"), "driver_id", "lap", "position", "lap_time_seconds",
        X.flag(F.col("stopped")).alias("is_pit_lap"),
    )
    covered = laps.select(*RACE).distinct()
    grid = collapse(
        joined.where(F.col("grid_position") > 0).join(covered, RACE, "left_semi"), DRIVER_RACE,
        position=F.min("grid_position"),
    ).select(
        X.race_id().alias("race_id"), "driver_id", F.lit(0).alias("lap"), "position",
        F.lit(None).cast("double").alias("lap_time_seconds"), F.lit(False).alias("is_pit_lap"),
    )
    return driven.unionByName(grid)


def fct_pit_stops(pit_stops: DataFrame) -> DataFrame:
    """M12."""
    return pit_stops.select(
        X.race_id().alias("race_id"), "driver_id", "stop_number", "lap", "time_of_day", "duration_seconds"
    )


def fct_teammate_qualifying(pairs: DataFrame, drivers: DataFrame) -> DataFrame:
    """M13. I4 with the teammate's name."""
    names = drivers.select(F.col("driver_id").alias("teammate_id"), F.col("driver_name").alias("teammate_name"))
    return pairs.join(names, "teammate_id", "left").select(
        X.race_id().alias("race_id"), "driver_id", "constructor_id", "teammate_id", "teammate_name",
        "qualifying_position", "teammate_qualifying_position", "beat_teammate", "session_compared",
        "qualifying_seconds", "teammate_qualifying_seconds", "gap_seconds", "gap_pct",
    )

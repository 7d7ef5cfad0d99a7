"""Report measures (R1 to R39) and page queries (V1 to V15) over the marts.

What a report tool would call the filter context is the ``by`` argument here:
the grouping keys. ``t`` is a function from a table name to its rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apexlake.functions import exprs as X
from apexlake.operators.grouping import collapse
from apexlake.operators.joins import calendar_rows, small_side
from apexlake.operators.ranking import dense_rank_integers, top_ranked

Tables = Callable[[str], DataFrame]

# Notes shown where the source has no data.
LAP_NOTE = "Lap-by-lap positions start in 1996"
PIT_NOTE = "Pit stop data starts in 2011"
QUALIFYING_NOTE = "Qualifying data starts in 1994"
FASTEST_LAP_NOTE = "Fastest laps are recorded from 2004"

DRIVERS_SHOWN = 5
MINIMUM_STARTS = 50
MINIMUM_RACES = 5
STREAK_PLACES = 10
NAMES_IN_A_CELL = 500
PAIR = ("season", "driver_id", "teammate_id", "teammate_name", "constructor_id")


def names(t: Tables) -> DataFrame:
    return t("dim_driver").select("driver_id", "driver_name")


def teams(t: Tables) -> DataFrame:
    return t("dim_constructor").select("constructor_id", "constructor_name")


def with_season(df: DataFrame) -> DataFrame:
    """The season is part of the race key, so no join is needed for it."""
    return df.withColumn("season", X.season_of())


# Points ------------------------------------------------------------------------
def total_points(t: Tables, by=("season", "driver_id")) -> DataFrame:
    """Race and sprint points."""
    return collapse(with_season(t("fct_points_by_round")), list(by), total_points=F.sum("total_points"))


def points_to_date(t: Tables, drivers: DataFrame | None = None) -> DataFrame:
    """R2: running points of a season at every round run, also those a driver missed.

    Each driver season is spread over the rounds of its season, at most 99, by
    exploding the season's own list. Nothing is known before the first entry.
    ``drivers`` restricts it to some driver seasons.
    """
    races = t("dim_race").where("has_results")
    rounds = races.groupBy("season").agg(F.collect_set(F.struct("race_id", "round")).alias("rounds"))
    scored = with_season(t("fct_points_by_round")).select("season", "race_id", "driver_id", "total_points")
    if drivers is not None:
        scored = scored.join(drivers.select("season", "driver_id"), ["season", "driver_id"], "left_semi")
    entrants = scored.select("season", "driver_id").distinct()
    spread = entrants.join(small_side(rounds, calendar_rows(races)), "season").select(
        "season", "driver_id", F.inline("rounds")
    )
    season_so_far = Window.partitionBy("season", "driver_id").orderBy("race_id")
    return spread.join(scored, ["season", "race_id", "driver_id"], "left").select(
        "season", "round", "race_id", "driver_id",
        F.sum("total_points").over(season_so_far).alias("points_to_date"),
    )


def standings_sum(t: Tables, measure: str, by=("driver_id",), out: str | None = None) -> DataFrame:
    """Championship points, points scored, points dropped."""
    return collapse(t("fct_driver_standings"), list(by), **{out or measure: F.sum(measure)})


# Results -----------------------------------------------------------------------
def wins(t: Tables, by=("driver_id",)) -> DataFrame:
    """Winning cars."""
    return collapse(with_season(t("fct_race_results")), list(by), wins=F.count_if("is_win"))


def podiums(t: Tables, by=("driver_id",)) -> DataFrame:
    """Cars on the podium."""
    return collapse(with_season(t("fct_race_results")), list(by), podiums=F.count_if("is_podium"))


def races_entered(t: Tables, by=("driver_id",)) -> DataFrame:
    """Distinct races, so a second car in a race does not count."""
    per_race = with_season(t("fct_race_results")).select(*dict.fromkeys([*by, "race_id"])).distinct()
    return collapse(per_race, list(by), races_entered=F.count("*"))


def avg_positions_gained(t: Tables, by=("driver_id",)) -> DataFrame:
    """Unknown gains are left out."""
    return collapse(
        with_season(t("fct_race_results")), list(by), avg_positions_gained=F.avg("positions_gained")
    )


def titles(t: Tables, by=("driver_id",)) -> DataFrame:
    """R10."""
    return collapse(t("fct_driver_standings"), list(by), titles=F.count_if("is_champion"))


# Championship --------------------------------------------------------------------
def _season_points(t: Tables) -> DataFrame:
    return standings_sum(t, "championship_points", by=("season", "driver_id"))


def _best_of_season(t: Tables, places: int) -> DataFrame:
    return top_ranked(
        _season_points(t), ["season"], "championship_points", places, groups=calendar_rows(t("dim_season"))
    )


def joined_names(holders: DataFrame, group: list[str], text: Column | str, out: str) -> DataFrame:
    """The texts of a group in one cell, in order.

    A cell is for reading: it holds at most ``NAMES_IN_A_CELL`` texts. One more is
    enough to tell that a group has too many, so no task gathers more than that;
    the job then ends with an error instead of dropping names. The rows
    themselves are ``holders``.
    """
    order = Window.partitionBy(*group).orderBy("_text")
    named = holders.select(*group, (F.col(text) if isinstance(text, str) else text).alias("_text"))
    listed = named.withColumn("_row", F.row_number().over(order)).where(F.col("_row") <= NAMES_IN_A_CELL + 1)
    cell = F.array_join(F.sort_array(F.collect_list("_text")), ", ")
    error = F.raise_error(F.lit(f"more than {NAMES_IN_A_CELL} names in a cell of {out}: take the rows of the holders"))
    return collapse(listed, group, **{out: F.when(F.count("*") <= NAMES_IN_A_CELL, cell).otherwise(error)})


def season_leaders(t: Tables) -> DataFrame:
    """Whoever leads a season, a row each: several where drivers are level at the top."""
    return _best_of_season(t, 1).join(names(t), "driver_id", "left").select("season", "driver_id", "driver_name", "championship_points")


def championship_leader(t: Tables) -> DataFrame:
    """Whoever leads; drivers level at the top share the cell."""
    return joined_names(season_leaders(t), ["season"], "driver_name", "championship_leader")


def leader_margin(t: Tables) -> DataFrame:
    """Points between first and second, 0 when two are level at the top."""
    points = F.col("championship_points")
    return collapse(_best_of_season(t, 2), ["season"], leader_margin=F.max(points) - F.min(points))


def season_progress(t: Tables) -> DataFrame:
    """R13."""
    text = F.format_string("%d of %d rounds", F.sum("races_completed"), F.sum("races_scheduled"))
    return collapse(t("dim_season"), ["season"], season_progress=text)


# Teammates -------------------------------------------------------------------------
def _pairs(t: Tables, by, **measures: Column) -> DataFrame:
    return collapse(with_season(t("fct_teammate_qualifying")), list(by), **measures)


def qualifying_sessions(t: Tables, by=PAIR) -> DataFrame:
    """R14."""
    return _pairs(t, by, qualifying_sessions=F.count("*"))


def head_to_head_wins(t: Tables, by=PAIR) -> DataFrame:
    """R15."""
    return _pairs(t, by, h2h_wins=F.count_if("beat_teammate"))


def head_to_head_losses(t: Tables, by=PAIR) -> DataFrame:
    """A session without a verdict is neither a win nor a loss."""
    return _pairs(t, by, h2h_losses=F.count_if(~F.col("beat_teammate")))


def _head_to_head() -> Column:
    lost = F.count_if(~F.col("beat_teammate"))
    return F.concat(F.count_if("beat_teammate").cast("string"), F.lit("–"), lost.cast("string"))


def head_to_head(t: Tables, by=PAIR) -> DataFrame:
    """Wins and losses as ``19–5``; only pairings that happened have a row."""
    return _pairs(t, by, head_to_head=_head_to_head())


def median_gap_percent(t: Tables, by=PAIR) -> DataFrame:
    """As a fraction. A group holds at most the sessions of one season or career."""
    return _pairs(t, by, median_gap_pct=F.median("gap_pct") / 100)


def median_gap_seconds(t: Tables, by=PAIR) -> DataFrame:
    """R19."""
    return _pairs(t, by, median_gap_seconds=F.median("gap_seconds"))


def _single(column: str, default: str) -> Column:
    """The value where only one occurs, the default otherwise."""
    return F.when(F.min(column) == F.max(column), F.max(column)).otherwise(F.lit(default))


def team_colour(t: Tables, column: str, default: str, by=("season", "driver_id")) -> DataFrame:
    """A colour where the selection has one team colour only."""
    raced = with_season(t("fct_teammate_qualifying")).select(*by, "constructor_id").distinct()
    colours = t("dim_constructor").select("constructor_id", column)
    return collapse(raced.join(colours, "constructor_id", "left"), list(by), **{column: _single(column, default)})


# Records ---------------------------------------------------------------------------
def meets_minimum_starts(t: Tables, minimum: int = MINIMUM_STARTS) -> DataFrame:
    """R22."""
    return collapse(
        t("fct_driver_careers"), ["driver_id"],
        meets_minimum_starts=F.when(F.sum("starts") >= minimum, 1).otherwise(0),
    )


def season_win_rate(t: Tables, by=("season", "driver_id")) -> DataFrame:
    """Blank without a race."""
    rate = F.try_divide(F.sum("race_wins"), F.sum("races_entered"))
    return collapse(t("fct_driver_standings"), list(by), season_win_rate=rate)


def season_points_per_start(t: Tables, by=("season", "driver_id")) -> DataFrame:
    """R24."""
    rate = F.try_divide(F.sum("modern_points"), F.sum("races_entered"))
    return collapse(t("fct_driver_standings"), list(by), season_modern_points_per_start=rate)


AGE_RECORDS = {
    "Youngest Winner": ("first_win", True),
    "Oldest Winner": ("last_win", False),
    "Youngest Podium": ("first_podium", True),
    "Oldest Podium": ("last_podium", False),
    "Youngest Champion": ("first_title", True),
    "Oldest Champion": ("last_title", False),
}


def record_holders(t: Tables, cards=tuple(AGE_RECORDS)) -> DataFrame:
    """Holders of the age records, a row each: ``card, days, age, driver_id, driver_name``; equal ages all hold it.

    All records in one scan of the careers. Each task keeps what is best in it
    before rows are compared across tasks, so only holders travel.
    """
    def entry(card: str) -> Column:
        milestone, youngest = AGE_RECORDS[card]
        days = F.col(f"age_{milestone}_days")
        return F.struct(
            F.lit(card).alias("card"), days.alias("days"), F.col(f"age_{milestone}").alias("age"),
            (days if youngest else -days).alias("_order"))

    entries = t("fct_driver_careers").select("driver_id", F.explode(F.array(*map(entry, cards))).alias("entry"))
    best = Window.partitionBy("card").orderBy("_order")
    first = entries.select("driver_id", "entry.*").where(F.col("days").isNotNull()).withColumn("_place", F.rank().over(best))
    holders = first.where(F.col("_place") == 1).join(names(t), "driver_id", "left")
    return holders.select("card", "days", "age", "driver_id", "driver_name")


def age_records(t: Tables, cards=tuple(AGE_RECORDS)) -> DataFrame:
    """Six cards, ``name – 18y 228d`` of the record holder; equal ages share the cell, nobody leaves it empty."""
    holders = record_holders(t, cards)
    text = F.concat("driver_name", F.lit(" – "), "age")
    cells = joined_names(holders, ["card"], text, "holder")
    listed = holders.sparkSession.createDataFrame([(card,) for card in cards], "card string")
    return listed.join(cells, "card", "left").select("card", F.coalesce("holder", F.lit("")).alias("holder"))


def age_record(t: Tables, milestone: str, youngest: bool) -> DataFrame:
    """One of the cards."""
    card = next(c for c, record in AGE_RECORDS.items() if record == (milestone, youngest))
    return age_records(t, (card,)).select("holder")


# Race weekend ------------------------------------------------------------------------
def lap_position(t: Tables) -> DataFrame:
    """R31."""
    return collapse(t("fct_lap_positions"), ["race_id", "driver_id", "lap"], lap_position=F.min("position"))


def finish_position(t: Tables) -> DataFrame:
    """The better of two cars."""
    return collapse(t("fct_race_results"), ["race_id", "driver_id"], finish_position=F.min("finish_position"))


def finish_rank(t: Tables) -> DataFrame:
    """Dense rank among the drivers of the race."""
    return dense_rank_integers(finish_position(t), ["race_id"], "finish_position", "finish_rank").select(
        "race_id", "driver_id", "finish_rank"
    )


def show_driver(t: Tables, shown: int = DRIVERS_SHOWN) -> DataFrame:
    """1 for the first ``shown`` finishing ranks. An unknown rank counts as first, as a blank does."""
    leading = leading_drivers(t, shown).select("race_id", "driver_id", F.lit(True).alias("_leading"))
    show = F.col("_leading").isNotNull() | F.col("finish_position").isNull()
    return finish_position(t).join(leading, ["race_id", "driver_id"], "left").select(
        "race_id", "driver_id", show.cast("int").alias("show_driver"))


def leading_drivers(t: Tables, shown: int = DRIVERS_SHOWN) -> DataFrame:
    """The drivers in the first finishing ranks of every race, found without a complete ranking."""
    return top_ranked(
        finish_position(t), ["race_id"], "finish_position", shown, groups=calendar_rows(t("dim_race")),
        ascending=True, dense=True, out="finish_rank",
    ).select("race_id", "driver_id", "finish_rank")


def shown_drivers(t: Tables, shown: int = DRIVERS_SHOWN) -> DataFrame:
    """Who R34 shows: the leading drivers, and entrants whose finish is unknown."""
    unknown = finish_position(t).where(F.col("finish_position").isNull()).select("race_id", "driver_id")
    return leading_drivers(t, shown).select("race_id", "driver_id").unionByName(unknown)


def chart_position(t: Tables, shown: int = DRIVERS_SHOWN) -> DataFrame:
    """Lap positions of the drivers shown."""
    return lap_position(t).join(shown_drivers(t, shown), ["race_id", "driver_id"], "left_semi").select(
        "race_id", "driver_id", "lap", F.col("lap_position").alias("chart_position")
    )


def _covered(t: Tables, fact: str, flag: str) -> DataFrame:
    return t(fact).select("race_id").distinct().withColumn(flag, F.lit(True))


def lap_data_note(t: Tables) -> DataFrame:
    """Why a chart or table is empty; blank where there is nothing to explain."""
    note = F.when(F.col("has_laps").isNull(), LAP_NOTE).when(F.col("has_stops").isNull(), PIT_NOTE)
    return (
        t("dim_race").select("race_id")
        .join(_covered(t, "fct_lap_positions", "has_laps"), "race_id", "left")
        .join(_covered(t, "fct_pit_stops", "has_stops"), "race_id", "left")
        .select("race_id", note.alias("lap_data_note"))
    )


def fastest_lap(t: Tables) -> DataFrame:
    """``name – 1:32.608 (lap 39)``; a note without one, blank with several."""
    text = F.concat(
        "driver_name", F.lit(" – "), "fastest_lap_time", F.lit(" (lap "),
        F.col("fastest_lap_number").cast("string"), F.lit(")"),
    )
    holders = collapse(
        t("fct_race_results").where("is_fastest_lap").join(names(t), "driver_id", "left"), ["race_id"],
        holders=F.count("*"), text=F.max(text),
    )
    count = F.coalesce("holders", F.lit(0))
    return t("dim_race").select("race_id").join(holders, "race_id", "left").select("race_id", F.when(count == 1, F.col("text")).when(count == 0, FASTEST_LAP_NOTE).alias("fastest_lap"))


def fastest_lap_highlight(t: Tables) -> DataFrame:
    """The highlight colour for the holder, blank for the others."""
    return collapse(
        t("fct_race_results"), ["race_id", "driver_id"],
        fastest_lap_highlight=F.when(F.bool_or("is_fastest_lap"), X.FASTEST_LAP_COLOUR),
    )


def qualifying_data_note(t: Tables) -> DataFrame:
    """R39."""
    return t("dim_race").select("race_id").join(_covered(t, "fct_qualifying", "covered"), "race_id", "left").select(
        "race_id", F.when(F.col("covered").isNull(), QUALIFYING_NOTE).alias("qualifying_data_note")
    )


# Pages -----------------------------------------------------------------------------
def season_cards(t: Tables) -> DataFrame:
    """V1."""
    return (
        season_progress(t).join(championship_leader(t), "season", "left").join(leader_margin(t), "season", "left")
    )


def season_standings(t: Tables) -> DataFrame:
    """V2: in championship order within a season."""
    counts = collapse(
        with_season(t("fct_race_results")), ["season", "driver_id"],
        wins=F.count_if("is_win"), podiums=F.count_if("is_podium"),
    )
    return (
        t("fct_driver_standings")
        .select("season", "driver_id", "championship_position", "constructor_names", "championship_points")
        .join(counts, ["season", "driver_id"], "left").join(names(t), "driver_id", "left")
        .select(
            "season", "championship_position", "driver_name", "constructor_names", "championship_points",
            F.coalesce("wins", F.lit(0)).alias("wins"), F.coalesce("podiums", F.lit(0)).alias("podiums"),
        )
        .orderBy("season", F.col("championship_position").asc_nulls_last(), "driver_name")
    )


def points_progression(t: Tables, shown: int = DRIVERS_SHOWN) -> DataFrame:
    """V3: running points of the season's top drivers, rounds with results only."""
    return points_to_date(t, _best_of_season(t, shown)).join(names(t), "driver_id", "left").select(
        "season", "round", "driver_name", "points_to_date"
    ).orderBy("season", "round", "driver_name")


def race_result(t: Tables) -> DataFrame:
    """V4: in finishing order within a race."""
    return (
        t("fct_race_results").join(names(t), "driver_id", "left").join(teams(t), "constructor_id", "left")
        .select(
            "race_id", "finish_position", "finish_position_text", "driver_name", "constructor_name",
            "qualifying_position", "grid_position", "positions_gained", "status",
        )
        .orderBy("race_id", "finish_position")
    )


def positions_gained(t: Tables) -> DataFrame:
    """V5: per race, biggest gain first."""
    return (
        avg_positions_gained(t, by=("race_id", "driver_id")).join(names(t), "driver_id", "left")
        .select("race_id", "driver_name", "avg_positions_gained")
        .orderBy("race_id", F.col("avg_positions_gained").desc_nulls_last(), "driver_name")
    )


def position_chart(t: Tables, shown: int = DRIVERS_SHOWN) -> DataFrame:
    """V6: from the grid on."""
    return chart_position(t, shown).join(names(t), "driver_id", "left").select(
        "race_id", "lap", "driver_name", "chart_position"
    ).orderBy("race_id", "lap", "chart_position")


def pit_stop_table(t: Tables, shown: int = DRIVERS_SHOWN) -> DataFrame:
    """V7: stops of the drivers in the chart, by lap."""
    return (
        t("fct_pit_stops").join(shown_drivers(t, shown), ["race_id", "driver_id"], "left_semi")
        .join(names(t), "driver_id", "left")
        .select("race_id", "driver_name", "stop_number", "lap", "duration_seconds")
        .orderBy("race_id", "lap", "driver_name")
    )


def qualifying_table(t: Tables) -> DataFrame:
    """V8: with the team's colours for its cell."""
    team = t("dim_constructor").select("constructor_id", "constructor_name", "team_colour", "text_colour")
    return (
        t("fct_qualifying").join(names(t), "driver_id", "left").join(team, "constructor_id", "left")
        .select(
            "race_id", "qualifying_position", "driver_name", "constructor_name", "q1_time", "q2_time", "q3_time",
            "gap_seconds", "grid_position", "team_colour", "text_colour",
        )
        .orderBy("race_id", "qualifying_position")
    )


def race_cards(t: Tables) -> DataFrame:
    """V9: fastest lap and the notes on missing data."""
    return fastest_lap(t).join(lap_data_note(t), "race_id").join(qualifying_data_note(t), "race_id")


def teammate_battles(t: Tables) -> DataFrame:
    """Most dominant driver first; every pairing appears from both sides."""
    battles = _pairs(
        t, PAIR, qualifying_sessions=F.count("*"), head_to_head=_head_to_head(),
        median_gap_seconds=F.median("gap_seconds"), median_gap_pct=F.median("gap_pct") / 100,
    )
    team = t("dim_constructor").select("constructor_id", "constructor_name", "team_colour", "text_colour")
    return (
        battles.join(names(t), "driver_id", "left").join(team, "constructor_id", "left")
        .select(
            "season", "driver_name", "teammate_name", "constructor_name", "qualifying_sessions", "head_to_head",
            "median_gap_seconds", "median_gap_pct", "team_colour", "text_colour",
        )
        .orderBy("season", "median_gap_pct")
    )


def career_leaderboard(t: Tables, minimum_starts: int = MINIMUM_STARTS) -> DataFrame:
    """Ranked by era-neutral points per start among drivers with enough starts."""
    careers = t("fct_driver_careers").where(F.col("starts") >= minimum_starts)
    return careers.join(names(t), "driver_id", "left").select(
        "driver_name", "starts", "titles", "wins", "win_rate", "podiums", "podium_rate", "poles", "pole_rate",
        "modern_points_per_start",
    ).orderBy(F.col("modern_points_per_start").desc(), "driver_name")


def best_seasons(t: Tables, minimum_races: int = MINIMUM_RACES) -> DataFrame:
    """Most wins first, seasons with enough races."""
    return (
        t("fct_driver_standings").where(F.col("races_entered") >= minimum_races)
        .join(names(t), "driver_id", "left")
        .select(
            "season", "driver_name", "race_wins", "races_entered",
            F.try_divide("race_wins", "races_entered").alias("season_win_rate"),
            F.try_divide("modern_points", "races_entered").alias("season_modern_points_per_start"),
        )
        .orderBy(F.col("race_wins").desc(), "season", "driver_name")
    )


def title_margins(t: Tables) -> DataFrame:
    """Widest first."""
    champions = t("fct_driver_standings").where("is_champion").select("season", "driver_id", "championship_points")
    return (
        champions.join(t("dim_season").select("season", "title_margin"), "season", "left")
        .join(names(t), "driver_id", "left")
        .select("season", "driver_name", "championship_points", "title_margin")
        .orderBy(F.col("title_margin").desc())
    )


def streak_records(t: Tables, places: int = STREAK_PLACES) -> DataFrame:
    """The best places of each kind, ties kept; a driver may hold several."""
    return (
        t("fct_driver_streaks").where(F.col("streak_rank") <= places).join(names(t), "driver_id", "left")
        .select(
            "streak_type", "streak_rank", "driver_name", "streak_length", "first_race", "last_race",
            "runs_to_latest_start",
        )
        .orderBy("streak_type", "streak_rank", "driver_name")
    )

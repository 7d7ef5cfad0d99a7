"""Reconciliations and invariants across tables.

Each takes ``t``, a function from a table name to its rows, and returns the
violating rows. Lists of races come from an earlier layer than the table under
test, so one that loses a race still fails.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apexlake.functions import exprs as X
from apexlake.operators.grouping import collapse, reconcile
from apexlake.operators.joins import measured_side, spine_left_join
from apexlake.session import write_once

Tables = Callable[[str], DataFrame]

# Seasons from which a rule holds.
ALL_SCORES_COUNT_FROM = 1991
NO_SHARED_CARS_FROM = 1965
ONE_WINNER_FROM = 1958
STREAK_FLAGS = {"win": "won", "podium": "podium", "points": "scored_points"}


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def _race_ids(df: DataFrame) -> DataFrame:
    return df.select(X.race_id().alias("race_id")).distinct()


def champions_only_when_finished(t: Tables) -> DataFrame:
    """A1: no champion in a running season, exactly one in a finished one."""
    champions = collapse(t("fct_driver_standings"), ["season"], champions=F.count_if("is_champion"))
    seasons = t("dim_season").select("season", "races_completed", "races_scheduled")
    done, planned = F.col("races_completed"), F.col("races_scheduled")
    wrong = ((done < planned) & (F.col("champions") > 0)) | ((done == planned) & (F.col("champions") != 1))
    return spine_left_join(seasons, champions, ["season"], zero=("champions",)).where(wrong)


def positions_unique(t: Tables) -> DataFrame:
    """A2: a classified championship position belongs to one entrant."""
    both = t("stg_driver_standings").select(
        F.lit("drivers").alias("championship"), "season", "championship_position"
    ).unionByName(t("stg_constructor_standings").select(
        F.lit("constructors").alias("championship"), "season", "championship_position"
    ))
    counted = collapse(
        both.where(F.col("championship_position").isNotNull()),
        ["championship", "season", "championship_position"], entrants=F.count("*"),
    )
    return counted.where(F.col("entrants") > 1)


def ages_plausible(t: Tables) -> DataFrame:
    """A3: winners and champions are between 16 and 60."""
    names = ["first_win", "last_win", "first_podium", "last_podium", "first_title", "last_title"]
    careers = t("fct_driver_careers").select(
        "driver_id", *[F.col(f"age_{n}_days").alias(n) for n in names]
    )
    ages = careers.unpivot("driver_id", names, "record", "age_days")
    return ages.where((F.col("age_days") < 16 * 365) | (F.col("age_days") > 60 * 366))


def careers_reconcile(t: Tables) -> DataFrame:
    """A4: career totals follow from race results and standings.

    Cars are collapsed per race first, which counts distinct races without
    expanding every row once per counted condition.
    """
    per_race = collapse(
        t("fct_race_results"), ["driver_id", "race_id"], won=F.bool_or("is_win"), podium=F.bool_or("is_podium")
    )
    counted = collapse(
        per_race, ["driver_id"], starts=F.count("*"), wins=F.count_if("won"), podiums=F.count_if("podium")
    )
    titles = collapse(t("fct_driver_standings"), ["driver_id"], titles=F.count_if("is_champion"))
    totals = ["starts", "wins", "podiums", "titles"]
    careers = t("fct_driver_careers").select("driver_id", *[F.col(c).alias(f"career_{c}") for c in totals])
    expected = spine_left_join(counted, titles, ["driver_id"], zero=("titles",))
    wrong = X.any_of([F.col("career_starts").isNull()] + [F.col(c) != F.col(f"career_{c}") for c in totals])
    return reconcile(expected, careers, ["driver_id"], wrong).select(
        "driver_id", *[c for total in totals for c in (total, f"career_{total}")]
    )


def form_points_match(t: Tables) -> DataFrame:
    """A5: points summed over a driver's form equal the published ones once all scores count."""
    summed = collapse(t("int_driver_form"), ["season", "driver_id"], points_from_form=F.sum("points"))
    published = t("stg_driver_standings").where(F.col("season") >= ALL_SCORES_COUNT_FROM).select(
        "season", "driver_id", "championship_points"
    )
    wrong = F.coalesce("points_from_form", F.lit(0.0)) != F.col("championship_points")
    return reconcile(published, summed, ["season", "driver_id"], wrong)


def era_neutral_points_follow_scale(t: Tables) -> DataFrame:
    """A race pays the scale down to its last classified finisher."""
    modern = F.col("season") >= NO_SHARED_CARS_FROM
    scale = F.array(*[F.lit(p) for p in X.ERA_NEUTRAL_POINTS])
    paid = F.least(F.count_if("was_classified"), F.lit(len(X.ERA_NEUTRAL_POINTS))).cast("int")
    total = F.aggregate(F.slice(scale, 1, paid), F.lit(0), lambda sum_, p: sum_ + p).cast("bigint")
    expected = t("int_results_qualifying").where(modern).groupBy("season", "round").agg(
        total.alias("modern_points_expected")
    )
    awarded = collapse(
        t("int_driver_race").where(modern), ["season", "round"], modern_points_awarded=F.sum("modern_points")
    )
    wrong = _differs(F.col("modern_points_expected"), F.col("modern_points_awarded"))
    return reconcile(expected, awarded, ["season", "round"], wrong)


def one_winner_per_race(t: Tables) -> DataFrame:
    """Every race has a winner, and only one since cars are no longer shared."""
    spine = t("int_results_qualifying").select("season", "round").distinct()
    winners = collapse(t("int_driver_race"), ["season", "round"], winners=F.count_if("won"))
    wrong = (_zero("winners") == 0) | ((F.col("season") >= ONE_WINNER_FROM) & (F.col("winners") != 1))
    return reconcile(spine, winners, ["season", "round"], wrong)


def streaks_exact_and_maximal(t: Tables) -> DataFrame:
    """A streak spans as many qualifying starts as it says and could not be longer.

    Running counts and neighbours are attached to the starts, so the streak's
    two ends are looked up by key instead of joining everything in between.
    """
    career = Window.partitionBy("driver_id").orderBy("race_date", "race_id")
    so_far = career.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = t("int_driver_race").select("driver_id", "race_id", F.row_number().over(career).alias("number"), F.array(*[
        F.struct(
            F.lit(name).alias("streak_type"),
            F.sum(X.as_count(F.col(flag))).over(so_far).alias("hits"), X.as_count(F.col(flag)).alias("hit"),
            F.lag(flag).over(career).alias("before"), F.lead(flag).over(career).alias("after"),
        ) for name, flag in STREAK_FLAGS.items()
    ]).alias("kinds")).select("driver_id", "race_id", "number", F.inline("kinds"))
    first = ends.select(
        "driver_id", "streak_type", F.col("race_id").alias("first_race_id"), F.col("number").alias("first_number"),
        (F.col("hits") - F.col("hit")).alias("hits_before"), "before",
    )
    last = ends.select(
        "driver_id", "streak_type", F.col("race_id").alias("last_race_id"), F.col("number").alias("last_number"),
        "hits", "after",
    )
    spanned = F.col("last_number") - F.col("first_number") + 1
    inside = F.when(spanned > 0, F.col("hits") - F.col("hits_before"))
    length = F.col("streak_length")
    measured = (
        t("fct_driver_streaks").select("driver_id", "streak_type", "first_race_id", "last_race_id", "streak_length")
        .join(first, ["driver_id", "streak_type", "first_race_id"], "left")
        .join(last, ["driver_id", "streak_type", "last_race_id"], "left")
        .select(
            "driver_id", "streak_type", "first_race_id", "streak_length", "first_number", "last_number",
            spanned.alias("starts_spanned"), inside.alias("qualifying_inside"),
            F.greatest("before", "after").alias("neighbour_qualifies"),
        )
    )
    return measured.where(X.any_of([
        F.col("first_number").isNull(), F.col("last_number").isNull(), F.col("starts_spanned") != length,
        _zero("qualifying_inside") != length, X.flag(F.col("neighbour_qualifies")),
    ]))


def streaks_cover_starts(t: Tables) -> DataFrame:
    """The streaks of a driver add up to the starts that qualify."""
    counted = collapse(
        t("int_driver_race"), ["driver_id"], **{n: F.count_if(flag) for n, flag in STREAK_FLAGS.items()}
    ).unpivot("driver_id", list(STREAK_FLAGS), "streak_type", "qualifying_starts")
    covered = collapse(t("fct_driver_streaks"), ["driver_id", "streak_type"], streak_starts=F.sum("streak_length"))
    wrong = _zero("streak_starts") != F.col("qualifying_starts")
    return reconcile(counted, covered, ["driver_id", "streak_type"], wrong)


def finished_seasons_have_margin(t: Tables) -> DataFrame:
    """A10: a finished earlier season has a title margin of zero or more."""
    margin = F.col("title_margin")
    return t("dim_season").where(
        (F.col("races_completed") == F.col("races_scheduled")) & ~F.col("is_current_season")
        & (margin.isNull() | (margin < 0))
    ).select("season", "races_completed", "races_scheduled", "title_margin")


def finished_seasons_ran_sprints(t: Tables) -> DataFrame:
    """A finished season ran all its sprints."""
    return t("dim_season").where(
        (F.col("races_completed") == F.col("races_scheduled"))
        & (F.col("sprint_weekends_scheduled") != F.col("sprints_completed"))
    ).select("season", "sprint_weekends_scheduled", "sprints_completed")


def lap_positions_unique(t: Tables) -> DataFrame:
    """One driver per position and lap."""
    driven = t("fct_lap_positions").where(F.col("lap") >= 1)
    return collapse(driven, ["race_id", "lap", "position"], drivers=F.count("*")).where(F.col("drivers") > 1)


def last_lap_matches(t: Tables) -> DataFrame:
    """A13 (warning): the last lap recorded is the number of laps completed."""
    driver = ["race_id", "driver_id"]
    positions = t("fct_lap_positions").where(F.col("lap") >= 1)
    last = collapse(positions, driver, last_lap=F.max("lap"))
    # The few races are told to the drivers, who would otherwise come together by race.
    covered = measured_side(write_once(positions.select("race_id").distinct(), "races-with-laps"))
    done = collapse(
        t("fct_race_results").join(covered, "race_id", "left_semi"), driver, laps_completed=F.max("laps_completed")
    )
    races = measured_side(_race_ids(t("raw_laps")))
    compared = done.join(races, "race_id", "left_semi").join(last, driver, "left")
    unequal = (F.col("laps_completed") > 0) & _differs(F.col("last_lap"), F.col("laps_completed"))
    wrong = compared.where(F.col("driver_id").isNull() | unequal).select(*driver, "laps_completed", "last_lap")
    without = races.join(done.select("race_id").distinct(), "race_id", "left_anti").select("race_id")
    return wrong.unionByName(without, allowMissingColumns=True)


def lap_zero_is_the_grid(t: Tables) -> DataFrame:
    """Every grid slot of a race with laps starts a line at lap 0."""
    driver = ["race_id", "driver_id"]
    grid = collapse(
        t("fct_race_results").where(F.col("grid_position") > 0).join(_race_ids(t("raw_laps")), "race_id", "left_semi"),
        driver, grid_position=F.min("grid_position"),
    )
    start = t("fct_lap_positions").where(F.col("lap") == 0).select(*driver, "position")
    return reconcile(grid, start, driver, _differs(F.col("position"), F.col("grid_position")))


def one_fastest_lap(t: Tables) -> DataFrame:
    """Exactly one fastest lap in a race that recorded any."""
    spine = _race_ids(t("stg_results").where(F.col("fastest_lap_time").isNotNull()))
    found = collapse(t("fct_race_results").where("is_fastest_lap"), ["race_id"], fastest_laps=F.count("*"))
    return reconcile(spine, found, ["race_id"], _zero("fastest_laps") != 1)


def durations_read_back(t: Tables) -> DataFrame:
    """Seconds written out again give the text they were read from.

    Text that is no duration must have no seconds.
    """
    texts = t("stg_laps").select(F.col("lap_time").alias("source_time"), F.col("lap_time_seconds").alias("seconds")).unionByName(
        t("stg_pit_stops").select(F.col("duration").alias("source_time"), F.col("duration_seconds").alias("seconds"))
    )
    for n in (1, 2, 3):
        texts = texts.unionByName(t("stg_qualifying").select(
            F.col(f"q{n}_time").alias("source_time"), F.col(f"q{n}_seconds").alias("seconds")
        ))
    ms = F.round(F.col("seconds") * 1000).cast("bigint")
    minutes, rest = F.floor(ms / 60000), ms % 60000
    written = F.when(minutes > 0, F.format_string("%d:%06.3f", minutes, rest / 1000)).when(
        minutes == 0, F.format_string("%.3f", rest / 1000)
    )
    is_duration = F.col("source_time").rlike("^([0-9]+:)?[0-9]+[.][0-9]{3}$")
    expected = F.when(is_duration, F.col("source_time"))
    return texts.where(_differs(written, expected)).groupBy("source_time", "seconds").agg(F.count("*").alias("n"))


def pit_stops_on_laps_driven(t: Tables) -> DataFrame:
    """Nobody stops after their last lap, in races with lap data."""
    driver = ["race_id", "driver_id"]
    last = collapse(t("fct_lap_positions").where(F.col("lap") >= 1), driver, last_lap=F.max("lap"))
    stops = t("fct_pit_stops").join(last.select("race_id").distinct(), "race_id", "left_semi")
    wrong = F.col("last_lap").isNull() | (F.col("lap") > F.col("last_lap"))
    return reconcile(stops, last, driver, wrong).select(*driver, "stop_number", "lap", "last_lap")


def points_by_round_reconcile(t: Tables) -> DataFrame:
    """Points by round add up to the points scored in the season."""
    summed = collapse(
        t("fct_points_by_round").withColumn("season", X.season_of()), ["season", "driver_id"],
        points_by_round=F.sum("total_points"),
    )
    standings = t("fct_driver_standings").select("season", "driver_id", "points_scored")
    wrong = F.abs(F.coalesce("points_by_round", F.lit(0.0)) - F.col("points_scored")) > 0.001
    return reconcile(standings, summed, ["season", "driver_id"], wrong)


def nothing_dropped_since(t: Tables) -> DataFrame:
    """Published and scored points agree once all scores count."""
    return t("fct_driver_standings").where(
        (F.col("season") >= ALL_SCORES_COUNT_FROM) & (F.col("points_dropped") != 0)
    ).select("season", "driver_id", "championship_points", "points_scored", "points_dropped")


def pole_gap_is_zero(t: Tables) -> DataFrame:
    """Pole has no gap, and nobody has a negative one."""
    timed_pole = (F.col("qualifying_position") == 1) & F.col("final_session_seconds").isNotNull()
    gap = F.col("gap_seconds")
    return t("fct_qualifying").where((gap < 0) | (timed_pole & _differs(gap, F.lit(0.0)))).select(
        "race_id", "driver_id", "qualifying_position", "gap_seconds"
    )


def one_pole_per_race(t: Tables) -> DataFrame:
    """One driver qualified first."""
    poles = collapse(
        t("fct_qualifying").where(F.col("qualifying_position") == 1), ["race_id"], pole_sitters=F.count("*")
    )
    return reconcile(_race_ids(t("stg_qualifying")), poles, ["race_id"], _zero("pole_sitters") != 1)


def standings_match_starts(t: Tables) -> DataFrame:
    """A season's poles and era-neutral points are those of its starts."""
    counted = collapse(
        t("int_driver_race"), ["season", "driver_id"],
        expected_poles=F.count_if("pole"), expected_modern_points=F.sum("modern_points"),
    )
    standings = t("fct_driver_standings").select("season", "driver_id", "poles", "modern_points")
    wrong = X.any_of([_differs(F.col(c), _zero(f"expected_{c}")) for c in ("poles", "modern_points")])
    return reconcile(standings, counted, ["season", "driver_id"], wrong)


def colours_are_hex(colours: DataFrame) -> DataFrame:
    """Colours are written as six upper-case hex digits."""
    return colours.where(~F.col("team_colour").rlike("^#[0-9A-F]{6}$")).select("constructor_id", "team_colour")


def compared_in_last_shared_session(t: Tables) -> DataFrame:
    """The session compared is the last one both drivers timed."""
    timed = t("stg_qualifying").select(
        "season", "round", "driver_id", *[F.col(f"q{n}_seconds").isNotNull().alias(f"q{n}") for n in (1, 2, 3)]
    )
    other = timed.select("season", "round", F.col("driver_id").alias("teammate_id"),
                         *[F.col(f"q{n}").alias(f"other_q{n}") for n in (1, 2, 3)])
    pairs = t("int_teammate_qualifying").select("season", "round", "driver_id", "teammate_id", "session_compared")
    both = pairs.join(timed, ["season", "round", "driver_id"]).join(other, ["season", "round", "teammate_id"]).select(
        "season", "round", "driver_id", "teammate_id", "session_compared",
        *[(F.col(f"q{n}") & F.col(f"other_q{n}")).alias(f"both_q{n}") for n in (1, 2, 3)],
    )
    expected = F.coalesce(*[F.when(F.col(f"both_q{n}"), F.lit(f"Q{n}")) for n in (3, 2, 1)])
    return both.where(_differs(F.col("session_compared"), expected))


def two_car_teams_covered(t: Tables) -> DataFrame:
    """Two rows for every team that entered two cars, none for the others."""
    team = ["season", "round", "constructor_id"]
    entered = collapse(t("stg_qualifying"), team, cars=F.count("*")).where(F.col("cars") == 2)
    paired = collapse(t("int_teammate_qualifying"), team, rows_paired=F.count("*"))
    wrong = F.col("cars").isNull() | (_zero("rows_paired") != 2)
    return reconcile(entered, paired, team, wrong, how="full_outer").select(*team, "rows_paired")


def pairs_mirror(t: Tables) -> DataFrame:
    """The two rows of a pair say the same from opposite sides."""
    keys = ["season", "round", "constructor_id", "driver_id", "teammate_id"]
    said = ["session_compared", "gap_seconds", "beat_teammate"]
    mine = t("int_teammate_qualifying").select(*keys, *said)
    theirs = mine.select(
        *keys[:3], F.col("teammate_id").alias("driver_id"), F.col("driver_id").alias("teammate_id"),
        F.lit(True).alias("found"), *[F.col(c).alias(f"teammate_{c}") for c in said],
    )
    wrong = X.any_of([
        F.col("found").isNull(),
        _differs(F.col("session_compared"), F.col("teammate_session_compared")),
        _differs(F.col("gap_seconds"), -F.col("teammate_gap_seconds")),
        _differs(F.col("beat_teammate"), ~F.col("teammate_beat_teammate")),
    ])
    return reconcile(mine, theirs, keys, wrong).select(
        "season", "round", "driver_id", "teammate_id", *[c for s in said for c in (s, f"teammate_{s}")]
    )


def compared_teams_have_colour(t: Tables) -> DataFrame:
    """A team that can be compared has a colour of its own."""
    teams = t("fct_teammate_qualifying").select("constructor_id").distinct()
    return teams.join(t("team_colours"), "constructor_id", "left_anti")


def unclassified_have_no_position(t: Tables) -> DataFrame:
    """No position exactly where the text is no number; a missing text passes here."""
    columns = ["championship_position", "championship_position_text"]
    both = t("stg_driver_standings").select(*columns).unionByName(t("stg_constructor_standings").select(*columns))
    numbered = X.is_classified(F.col("championship_position_text"))
    return both.where(F.col("championship_position").isNull() == numbered)


ASSERTIONS: dict[str, tuple[Callable[[Tables], DataFrame], str]] = {
    "A01": (champions_only_when_finished, "error"),
    "A02": (positions_unique, "error"),
    "A03": (ages_plausible, "error"),
    "A04": (careers_reconcile, "error"),
    "A05": (form_points_match, "error"),
    "A06": (era_neutral_points_follow_scale, "error"),
    "A07": (one_winner_per_race, "error"),
    "A08": (streaks_exact_and_maximal, "error"),
    "A09": (streaks_cover_starts, "error"),
    "A10": (finished_seasons_have_margin, "error"),
    "A11": (finished_seasons_ran_sprints, "error"),
    "A12": (lap_positions_unique, "error"),
    "A13": (last_lap_matches, "warn"),
    "A14": (lap_zero_is_the_grid, "error"),
    "A15": (one_fastest_lap, "error"),
    "A16": (durations_read_back, "error"),
    "A17": (pit_stops_on_laps_driven, "error"),
    "A18": (points_by_round_reconcile, "error"),
    "A19": (nothing_dropped_since, "error"),
    "A20": (pole_gap_is_zero, "error"),
    "A21": (one_pole_per_race, "error"),
    "A22": (standings_match_starts, "error"),
    "A23": (lambda t: colours_are_hex(t("team_colours")), "error"),
    "A24": (compared_in_last_shared_session, "error"),
    "A25": (two_car_teams_covered, "error"),
    "A26": (pairs_mirror, "error"),
    "A27": (compared_teams_have_colour, "error"),
    "A28": (unclassified_have_no_position, "error"),
}


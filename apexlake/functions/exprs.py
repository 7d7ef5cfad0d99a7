"""Column expressions shared by the jobs. Built-ins only, so they stay inside codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# today's scoring, used to compare eras (position 1 first).
ERA_NEUTRAL_POINTS = (25, 18, 15, 12, 10, 8, 6, 4, 2, 1)

# Colours used where a team has none of its own.
DEFAULT_TEAM_COLOUR = "#9E9E9E"
DEFAULT_TEXT_COLOUR = "#000000"
FASTEST_LAP_COLOUR = "#B138DD"

DURATION = r"^[0-9]+(:[0-9]{2}){0,2}([.][0-9]+)?$"
DIGITS = "^[0-9]+$"


def duration_seconds(text: Column) -> Column:
    """``1:31:44.742``, ``1:29.179`` or ``59.9`` as seconds; null for anything else."""

    def unit(from_the_right: int) -> Column:
        piece = F.split_part(text, F.lit(":"), F.lit(-from_the_right))
        return F.coalesce(piece.try_cast("double"), F.lit(0.0))

    return F.when(text.rlike(DURATION), unit(3) * 3600 + unit(2) * 60 + unit(1))


def session_start(date_text: Column, time_text: Column) -> Column:
    """UTC start of a session; null, not midnight, when the time is missing.

    Malformed text gives null as well: this layer casts softly throughout.
    """
    return F.when(F.trim(time_text) != "", F.try_to_timestamp(F.concat(date_text, F.lit("T"), time_text)))


def race_id(season="season", round_="round") -> Column:
    """Single-column race key: season 2024, round 21 is 202421."""
    return (F.col(season) * 100 + F.col(round_)).cast("int")


def season_of(race_key="race_id") -> Column:
    """Season encoded in a race key."""
    return F.floor(F.col(race_key) / 100).cast("int")


def age_label(event: Column, born: Column) -> Column:
    """Age in the form ``18y 228d``: whole birthdays, then days since the last one."""
    years = F.floor(F.months_between(event, born) / 12).cast("int")
    days = F.datediff(event, F.add_months(born, years * 12))
    return F.concat(years.cast("string"), F.lit("y "), days.cast("string"), F.lit("d"))


def best_time(*times: Column) -> Column:
    """Fastest of several session times; a session without a time is skipped."""
    return F.least(*times)


def is_classified(position_text: Column) -> Column:
    """Classified finishers carry a number as their result text, others a letter."""
    return position_text.rlike(DIGITS)


def places_gained(grid: Column, finish: Column, classified: Column) -> Column:
    """Places made up; null for pit-lane starts (slot 0), retirements and unknown ends.

    A result without any text is not known to be a retirement and still counts.
    """
    return F.when((grid != 0) & F.coalesce(classified, F.lit(True)), grid - finish)


def grid_penalty(grid: Column, qualified: Column) -> Column:
    """Slots lost between qualifying and the start; null for pit-lane starts."""
    return F.when(grid != 0, grid - qualified)


def era_neutral_points(position: Column) -> Column:
    """Points the position would earn today; 0 outside the scoring places."""
    scale = F.array(*[F.lit(p) for p in ERA_NEUTRAL_POINTS])
    return F.when(
        position.between(1, len(ERA_NEUTRAL_POINTS)), F.try_element_at(scale, position)
    ).otherwise(F.lit(0))


def flag(condition: Column) -> Column:
    """A comparison with unknown counted as no."""
    return F.coalesce(condition, F.lit(False))


def as_count(condition: Column) -> Column:
    """1 where the condition holds, 0 elsewhere, for conditional sums."""
    return F.when(condition, 1).otherwise(0)


def last_shared_session(mine: dict[str, Column], theirs: dict[str, Column]) -> Column:
    """Name of the latest session in which both set a time; sessions listed latest first."""
    sessions = [F.when(mine[n].isNotNull() & theirs[n].isNotNull(), F.lit(n)) for n in mine]
    return F.coalesce(*sessions)


def time_in(session: Column, times: dict[str, Column]) -> Column:
    """The time set in the named session."""
    return F.coalesce(*[F.when(session == name, value) for name, value in times.items()])


def gap_percent(a: Column, b: Column) -> Column:
    """Gap of ``a`` over ``b`` as a percentage of the faster of the two."""
    return (a - b) / F.least(a, b) * 100


def race_label(round_: Column, name: Column) -> Column:
    """``R01 · name``: unique within a season and in race order as plain text."""
    return F.format_string("R%02d · %s", round_, name)


def joined(names: Column) -> Column:
    """An array of names as one comma-separated string."""
    return F.array_join(names, ", ")


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)

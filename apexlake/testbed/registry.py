"""Every query by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apexlake.functions.exprs import DEFAULT_TEAM_COLOUR, DEFAULT_TEXT_COLOUR, season_of
from apexlake.plans import checks, report
from apexlake.plans.assertions import ASSERTIONS, colours_are_hex
from apexlake.plans.quality import DECLARED
from apexlake.plans.warehouse import MODELS, Warehouse
from apexlake.testbed import catalogue, landing_queries, oracle, seeds
from apexlake.testbed.build import LANDED_ALSO, LANDED_AT, warehouse
from apexlake.testbed.oracle_checks import (
    ASSERTION_SQL, DAMAGE, accepted_sql, combination_sql, damaged_sql, not_null_sql, relationship_sql, union, unique_sql,
)
from apexlake.testbed.oracle_report import MEASURE_SQL, TEST_MINIMUM_RACES, TEST_MINIMUM_STARTS, VIEW_SQL


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def register(name: str, plan: Callable[[Warehouse], DataFrame], sql: str | None) -> None:
    QUERIES[name] = Query(lambda spark, folder: plan(warehouse(spark, folder)), sql and oracle.statement(sql))


# Models: planned over the written tables they read.
for _model in MODELS:
    register(_model, lambda w, m=_model: w.model(m), f"SELECT * FROM {_model}")

def _table(w: Warehouse) -> Callable[[str], DataFrame]:
    """Tables by name; the seed of colours is the file made from the teams of the test tables."""
    return lambda name: seeds.seed(w)[0] if name == "seed_rows" else w.table(name)


# Assertions: on the tables as they are, and on a damaged table, where each must report rows.
def _damaged(name: str) -> Callable[[Warehouse], DataFrame]:
    damage, (check, _) = DAMAGE[name], ASSERTIONS[name]

    def plan(w: Warehouse) -> DataFrame:
        broken = damage.spark(_table(w)(damage.table))
        if name == "A23":
            return colours_are_hex(broken)
        return check(lambda table: broken if table == damage.table else w.table(table))

    return plan


for _name, (_check, _severity) in ASSERTIONS.items():
    _clean = (lambda w: colours_are_hex(_table(w)("seed_rows"))) if _name == "A23" else (
        lambda w, c=_check: c(w.table))
    register(f"check_{_name}", _clean, ASSERTION_SQL[_name])
    register(f"check_{_name}_damaged", _damaged(_name), damaged_sql(_name))

# Declared checks, one line per check.
_NONE = checks.Declared({}, [], {}, [], [])
_DECLARED = {
    "dq_not_null": (replace(_NONE, not_null=DECLARED.not_null), not_null_sql),
    "dq_unique": (replace(_NONE, unique=DECLARED.unique), unique_sql),
    "dq_unique_combo": (replace(_NONE, combinations=DECLARED.combinations), combination_sql),
    "dq_relationships": (replace(_NONE, relationships=DECLARED.relationships), relationship_sql),
    "dq_accepted": (replace(_NONE, accepted=DECLARED.accepted), accepted_sql),
}
for _name, (_part, _sql) in _DECLARED.items():
    register(_name, lambda w, d=_part: checks.report(w.table, d, w.figures), union(_sql()))
register("dq_suite", lambda w: checks.report(w.table, DECLARED, w.figures), union([
    line for _, sql in _DECLARED.values() for line in sql()]))
register(
    "dq_build_fails", lambda w: checks.build_fails(checks.report(w.table, DECLARED, w.figures)),
    "SELECT * FROM (" + union([line for _, sql in _DECLARED.values() for line in sql()])
    + ") WHERE severity = 'error' AND violations > 0",
)
_OVER_TABLES = {**ASSERTIONS, "A23": (lambda table: colours_are_hex(table("seed_rows")), ASSERTIONS["A23"][1])}
register("dq_assertions", lambda w: checks.assertion_report(_table(w), _OVER_TABLES), union([
    f"SELECT 'all' AS \"table\", 'assertion' AS check_name, '{name}' AS target, '{severity}' AS severity, "
    f"(SELECT count(*) FROM ({ASSERTION_SQL[name]})) AS violations" for name, (_, severity) in _OVER_TABLES.items()
]))


def _freshness(w: Warehouse) -> DataFrame:
    now = F.lit(CHECKED_AT).cast("timestamp")
    return reduce(DataFrame.unionByName, [
        checks.freshness(landings, now).select(F.lit(endpoint).alias("endpoint"), "newest", "status")
        for endpoint, landings in w.logs.items()
    ])


CHECKED_AT = "2001-09-20 06:00:00"
_STAMPS = ", ".join(f"('{endpoint}', TIMESTAMP '{at}')" for endpoint, at in LANDED_ALSO.items())
register("dq_freshness", _freshness, f"""
SELECT endpoint, newest, CASE WHEN TIMESTAMP '{CHECKED_AT}' - newest > INTERVAL 30 DAY THEN 'error'
                              WHEN TIMESTAMP '{CHECKED_AT}' - newest > INTERVAL 10 DAY THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT endpoint, max(coalesce(stamp, TIMESTAMP '{LANDED_AT}')) AS newest
      FROM land_pages LEFT JOIN (VALUES {_STAMPS}) AS s(endpoint, stamp) USING (endpoint) GROUP BY endpoint)""")

# Report measures and pages.
_MEASURES: dict[str, Callable[..., DataFrame]] = {
    "R01": report.total_points,
    "R02": report.points_to_date,
    "R03": lambda t: report.standings_sum(t, "championship_points"),
    "R04": lambda t: report.standings_sum(t, "points_scored"),
    "R05": lambda t: report.standings_sum(t, "points_dropped"),
    "R06": report.wins,
    "R07": report.podiums,
    "R08": report.races_entered,
    "R09": report.avg_positions_gained,
    "R10": report.titles,
    "R11": report.championship_leader,
    "R12": report.leader_margin,
    "R13": report.season_progress,
    "R14": report.qualifying_sessions,
    "R15": report.head_to_head_wins,
    "R16": report.head_to_head_losses,
    "R17": report.head_to_head,
    "R18": report.median_gap_percent,
    "R19": report.median_gap_seconds,
    "R20": lambda t: report.team_colour(t, "team_colour", DEFAULT_TEAM_COLOUR),
    "R21": lambda t: report.team_colour(t, "text_colour", DEFAULT_TEXT_COLOUR),
    "R22": lambda t: report.meets_minimum_starts(t, TEST_MINIMUM_STARTS),
    "R23": report.season_win_rate,
    "R24": report.season_points_per_start,
    **{
        f"R{25 + i}": (lambda t, m=milestone, y=youngest: report.age_record(t, m, y))
        for i, (milestone, youngest) in enumerate(report.AGE_RECORDS.values())
    },
    "R31": report.lap_position,
    "R32": report.finish_position,
    "R33": report.finish_rank,
    "R34": report.show_driver,
    "R35": report.chart_position,
    "R36": report.lap_data_note,
    "R37": report.fastest_lap,
    "R38": report.fastest_lap_highlight,
    "R39": report.qualifying_data_note,
}
_VIEWS: dict[str, Callable[..., DataFrame]] = {
    "V01": report.season_cards,
    "V02": report.season_standings,
    "V03": report.points_progression,
    "V04": report.race_result,
    "V05": report.positions_gained,
    "V06": report.position_chart,
    "V07": report.pit_stop_table,
    "V08": report.qualifying_table,
    "V09": report.race_cards,
    "V10": report.teammate_battles,
    "V11": lambda t: report.career_leaderboard(t, TEST_MINIMUM_STARTS),
    "V12": lambda t: report.best_seasons(t, TEST_MINIMUM_RACES),
    "V13": report.title_margins,
    "V14": report.streak_records,
    "V15": report.age_records,
}
for _name, _measure in _MEASURES.items():
    register(f"measure_{_name}", lambda w, f=_measure: f(w.table), MEASURE_SQL[_name])
for _name, _view in _VIEWS.items():
    register(f"view_{_name}", lambda w, f=_view: f(w.table), VIEW_SQL[_name])

# Pages of what a reader has chosen: the last race run, and its season. Facts are pruned to the files of its season.
def _last_race(w: Warehouse) -> DataFrame:
    return w.table("dim_race").where("has_results").agg(F.max("race_id").alias("race_id"))


def _last_season(w: Warehouse) -> DataFrame:
    return w.table("dim_race").join(_last_race(w).select(season_of().alias("season")), "season", "left_semi").select("race_id")


_LAST = "(SELECT max(race_id) FROM dim_race WHERE has_results)"
for _name in ("V04", "V05", "V06", "V07", "V08", "V09"):
    register(f"race_page_{_name}", lambda w, f=_VIEWS[_name]: f(w.chosen(races=_last_race(w))),
             f"SELECT * FROM ({VIEW_SQL[_name]}) WHERE race_id = {_LAST}")
for _name in ("V01", "V02", "V03", "V10", "V13"):
    register(f"season_page_{_name}", lambda w, f=_VIEWS[_name]: f(w.chosen(races=_last_season(w))),
             f"SELECT * FROM ({VIEW_SQL[_name]}) WHERE season = {_LAST} // 100")
# The rows behind cells that several may share.
register("rows_season_leaders", lambda w: report.season_leaders(w.table),
         "SELECT season, driver_id, driver_name, pts AS championship_points FROM rep_season_points WHERE place = 1")
register("rows_record_holders", lambda w: report.record_holders(w.table), " UNION ALL ".join(f"""
SELECT '{card}' AS card, age_{m}_days AS days, age_{m} AS age, driver_id, driver_name
FROM fct_driver_careers LEFT JOIN rep_named USING (driver_id)
WHERE age_{m}_days = (SELECT {'min' if youngest else 'max'}(age_{m}_days) FROM fct_driver_careers)"""
    for card, (m, youngest) in report.AGE_RECORDS.items()))

# Landing, the seed and the catalogue.
for _name, (_plan, _statement) in {**landing_queries.QUERIES, **seeds.QUERIES, **catalogue.QUERIES}.items():
    register(_name, _plan, _statement)

"""SQL for the report measures and pages."""

from __future__ import annotations

from apexlake.plans import report
from apexlake.testbed.oracle import PARTS

# Short careers: the test tables hold about ten starts per driver.
TEST_MINIMUM_STARTS = 5
TEST_MINIMUM_RACES = 2

PAIR = "season, driver_id, teammate_id, teammate_name, constructor_id"
PARTS["rep_pairs"] = "SELECT race_id // 100 AS season, * FROM fct_teammate_qualifying"
PARTS["rep_cars"] = "SELECT race_id // 100 AS season, * FROM fct_race_results"
PARTS["rep_named"] = "SELECT driver_id, driver_name FROM dim_driver"
PARTS["rep_season_points"] = """
SELECT season, driver_id, driver_name, championship_points AS pts,
       rank() OVER (PARTITION BY season ORDER BY championship_points DESC) AS place
FROM fct_driver_standings LEFT JOIN rep_named USING (driver_id)"""
PARTS["rep_progress"] = """
WITH pts AS (SELECT race_id // 100 AS season, * FROM fct_points_by_round)
SELECT season, round, race_id, driver_id,
       (SELECT sum(total_points) FROM pts p
        WHERE p.season = e.season AND p.driver_id = e.driver_id AND p.race_id <= r.race_id) AS points_to_date
FROM (SELECT DISTINCT season, driver_id FROM pts) e JOIN (FROM dim_race WHERE has_results) r USING (season)"""
PARTS["rep_finish"] = """
SELECT race_id, driver_id, best AS finish_position,
       CASE WHEN best IS NOT NULL THEN dense_rank() OVER (PARTITION BY race_id ORDER BY best NULLS LAST) END::INT AS finish_rank
FROM (SELECT race_id, driver_id, min(finish_position) AS best FROM fct_race_results GROUP BY ALL)"""
PARTS["rep_shown"] = f"SELECT race_id, driver_id FROM rep_finish WHERE ifnull(finish_rank, 0) <= {report.DRIVERS_SHOWN}"


def median(column: str) -> str:
    """The middle value, or half of each of the two in the middle."""
    sorted_ = f"list_sort(list({column}) FILTER ({column} IS NOT NULL))"
    return (
        f"(CASE WHEN count({column}) % 2 = 1 THEN {sorted_}[count({column}) // 2 + 1] "
        f"ELSE 0.5 * {sorted_}[count({column}) // 2] + 0.5 * {sorted_}[count({column}) // 2 + 1] END)"
    )


def by(keys: str, measure: str, table: str) -> str:
    return f"SELECT {keys}, {measure} FROM {table} GROUP BY {keys}"


def holder(milestone: str, edge: str) -> str:
    days = f"age_{milestone}_days"
    return f"""SELECT ifnull(string_agg(driver_name || ' – ' || age_{milestone}, ', ' ORDER BY driver_name || ' – ' || age_{milestone}), '')
 AS holder FROM fct_driver_careers LEFT JOIN rep_named USING (driver_id)
 WHERE {days} = (SELECT {edge}({days}) FROM fct_driver_careers)"""


LEADER = """SELECT season, string_agg(driver_name, ', ' ORDER BY driver_name) AS championship_leader
 FROM rep_season_points WHERE place = 1 GROUP BY season"""
MARGIN = """SELECT season, max(pts) - min(pts) AS leader_margin FROM rep_season_points WHERE place <= 2 GROUP BY season"""
PROGRESS = "SELECT season, races_completed || ' of ' || races_scheduled || ' rounds' AS season_progress FROM dim_season"
H2H = ("count(*) FILTER (beat_teammate) || '–' || count(*) FILTER (NOT beat_teammate) AS head_to_head")
COLOUR = """SELECT season, driver_id, CASE WHEN count(DISTINCT {c}) = 1 THEN any_value({c}) ELSE '{d}' END AS {c}
 FROM rep_pairs JOIN dim_constructor USING (constructor_id) GROUP BY ALL"""
LAP_NOTE = f"""SELECT race_id, CASE WHEN race_id NOT IN (SELECT race_id FROM fct_lap_positions) THEN '{report.LAP_NOTE}'
 WHEN race_id NOT IN (SELECT race_id FROM fct_pit_stops) THEN '{report.PIT_NOTE}' END AS lap_data_note FROM dim_race"""
FASTEST = f"""SELECT race_id, CASE count(driver_id) WHEN 0 THEN '{report.FASTEST_LAP_NOTE}'
 WHEN 1 THEN any_value(driver_name || ' – ' || fastest_lap_time || ' (lap ' || fastest_lap_number || ')') END AS fastest_lap
 FROM dim_race LEFT JOIN (SELECT * FROM fct_race_results JOIN rep_named USING (driver_id) WHERE is_fastest_lap) USING (race_id)
 GROUP BY race_id"""
QUALIFYING_NOTE = f"""SELECT race_id, CASE WHEN race_id NOT IN (SELECT race_id FROM fct_qualifying)
 THEN '{report.QUALIFYING_NOTE}' END AS qualifying_data_note FROM dim_race"""
STARTS_RATE = "sum(modern_points) / nullif(sum(races_entered), 0)"

MEASURE_SQL = {
    "R01": by("season, driver_id", "sum(total_points) AS total_points",
              "(SELECT race_id // 100 AS season, * FROM fct_points_by_round)"),
    "R02": "SELECT * FROM rep_progress",
    "R03": by("driver_id", "sum(championship_points) AS championship_points", "fct_driver_standings"),
    "R04": by("driver_id", "sum(points_scored) AS points_scored", "fct_driver_standings"),
    "R05": by("driver_id", "sum(points_dropped) AS points_dropped", "fct_driver_standings"),
    "R06": by("driver_id", "count(*) FILTER (is_win) AS wins", "fct_race_results"),
    "R07": by("driver_id", "count(*) FILTER (is_podium) AS podiums", "fct_race_results"),
    "R08": by("driver_id", "count(DISTINCT race_id) AS races_entered", "fct_race_results"),
    "R09": by("driver_id", "avg(positions_gained) AS avg_positions_gained", "fct_race_results"),
    "R10": by("driver_id", "count(*) FILTER (is_champion) AS titles", "fct_driver_standings"),
    "R11": LEADER,
    "R12": MARGIN,
    "R13": PROGRESS,
    "R14": by(PAIR, "count(*) AS qualifying_sessions", "rep_pairs"),
    "R15": by(PAIR, "count(*) FILTER (beat_teammate) AS h2h_wins", "rep_pairs"),
    "R16": by(PAIR, "count(*) FILTER (NOT beat_teammate) AS h2h_losses", "rep_pairs"),
    "R17": by(PAIR, H2H, "rep_pairs"),
    "R18": by(PAIR, f"{median('gap_pct')} / 100 AS median_gap_pct", "rep_pairs"),
    "R19": by(PAIR, f"{median('gap_seconds')} AS median_gap_seconds", "rep_pairs"),
    "R20": COLOUR.format(c="team_colour", d="#9E9E9E"),
    "R21": COLOUR.format(c="text_colour", d="#000000"),
    "R22": f"SELECT driver_id, (starts >= {TEST_MINIMUM_STARTS})::INT AS meets_minimum_starts FROM fct_driver_careers",
    "R23": by("season, driver_id", "sum(race_wins) / nullif(sum(races_entered), 0) AS season_win_rate",
              "fct_driver_standings"),
    "R24": by("season, driver_id", f"{STARTS_RATE} AS season_modern_points_per_start", "fct_driver_standings"),
    "R25": holder("first_win", "min"),
    "R26": holder("last_win", "max"),
    "R27": holder("first_podium", "min"),
    "R28": holder("last_podium", "max"),
    "R29": holder("first_title", "min"),
    "R30": holder("last_title", "max"),
    "R31": by("race_id, driver_id, lap", "min(position) AS lap_position", "fct_lap_positions"),
    "R32": "SELECT race_id, driver_id, finish_position FROM rep_finish",
    "R33": "SELECT race_id, driver_id, finish_rank FROM rep_finish",
    "R34": f"SELECT race_id, driver_id, (ifnull(finish_rank, 0) <= {report.DRIVERS_SHOWN})::INT AS show_driver FROM rep_finish",
    "R35": """SELECT race_id, driver_id, lap, position AS chart_position FROM fct_lap_positions
 WHERE (race_id, driver_id) IN (SELECT (race_id, driver_id) FROM rep_shown)""",
    "R36": LAP_NOTE,
    "R37": FASTEST,
    "R38": by("race_id, driver_id", "CASE WHEN bool_or(is_fastest_lap) THEN '#B138DD' END AS fastest_lap_highlight",
              "fct_race_results"),
    "R39": QUALIFYING_NOTE,
}

VIEW_SQL = {
    "V01": f"SELECT * FROM ({PROGRESS}) LEFT JOIN ({LEADER}) USING (season) LEFT JOIN ({MARGIN}) USING (season)",
    "V02": """
SELECT season, championship_position, driver_name, constructor_names, championship_points,
       ifnull(w, 0) AS wins, ifnull(p, 0) AS podiums
FROM fct_driver_standings LEFT JOIN rep_named USING (driver_id)
LEFT JOIN (SELECT season, driver_id, count(*) FILTER (is_win) AS w, count(*) FILTER (is_podium) AS p FROM rep_cars GROUP BY ALL)
  USING (season, driver_id)""",
    "V03": f"""
SELECT season, round, driver_name, points_to_date FROM rep_progress LEFT JOIN rep_named USING (driver_id)
WHERE (season, driver_id) IN (SELECT (season, driver_id) FROM rep_season_points WHERE place <= {report.DRIVERS_SHOWN})""",
    "V04": """
SELECT race_id, finish_position, finish_position_text, driver_name, constructor_name, qualifying_position, grid_position,
       positions_gained, status
FROM fct_race_results LEFT JOIN rep_named USING (driver_id) LEFT JOIN dim_constructor USING (constructor_id)""",
    "V05": """
SELECT race_id, any_value(driver_name) AS driver_name, avg(positions_gained) AS avg_positions_gained
FROM fct_race_results LEFT JOIN rep_named USING (driver_id) GROUP BY race_id, driver_id""",
    "V06": """
SELECT race_id, lap, driver_name, position AS chart_position
FROM fct_lap_positions JOIN rep_shown USING (race_id, driver_id) LEFT JOIN rep_named USING (driver_id)""",
    "V07": """
SELECT race_id, driver_name, stop_number, lap, duration_seconds
FROM fct_pit_stops JOIN rep_shown USING (race_id, driver_id) LEFT JOIN rep_named USING (driver_id)""",
    "V08": """
SELECT race_id, qualifying_position, driver_name, constructor_name, q1_time, q2_time, q3_time, gap_seconds, grid_position,
       team_colour, text_colour
FROM fct_qualifying LEFT JOIN rep_named USING (driver_id) LEFT JOIN dim_constructor USING (constructor_id)""",
    "V09": f"SELECT * FROM ({FASTEST}) JOIN ({LAP_NOTE}) USING (race_id) JOIN ({QUALIFYING_NOTE}) USING (race_id)",
    "V10": f"""
SELECT season, driver_name, teammate_name, constructor_name, qualifying_sessions, head_to_head, median_gap_seconds,
       median_gap_pct, team_colour, text_colour
FROM ({by(PAIR, f"count(*) AS qualifying_sessions, {H2H}, {median('gap_seconds')} AS median_gap_seconds, "
                f"{median('gap_pct')} / 100 AS median_gap_pct", "rep_pairs")})
LEFT JOIN rep_named USING (driver_id) LEFT JOIN dim_constructor USING (constructor_id)""",
    "V11": f"""
SELECT driver_name, starts, titles, wins, win_rate, podiums, podium_rate, poles, pole_rate, modern_points_per_start
FROM fct_driver_careers LEFT JOIN rep_named USING (driver_id) WHERE starts >= {TEST_MINIMUM_STARTS}""",
    "V12": f"""
SELECT season, driver_name, race_wins, races_entered, race_wins / races_entered AS season_win_rate,
       modern_points / races_entered AS season_modern_points_per_start
FROM fct_driver_standings LEFT JOIN rep_named USING (driver_id) WHERE races_entered >= {TEST_MINIMUM_RACES}""",
    "V13": """
SELECT season, driver_name, championship_points, title_margin
FROM fct_driver_standings LEFT JOIN rep_named USING (driver_id) LEFT JOIN dim_season USING (season) WHERE is_champion""",
    "V14": f"""
SELECT streak_type, streak_rank, driver_name, streak_length, first_race, last_race, runs_to_latest_start
FROM fct_driver_streaks LEFT JOIN rep_named USING (driver_id) WHERE streak_rank <= {report.STREAK_PLACES}""",
    "V15": " UNION ALL ".join(
        f"SELECT '{card}' AS card, * FROM ({holder(milestone, 'min' if youngest else 'max')})"
        for card, (milestone, youngest) in report.AGE_RECORDS.items()
    ),
}

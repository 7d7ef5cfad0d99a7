"""SQL for the checks, and the damage done to a table to see each assertion fail."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apexlake.plans import quality
from apexlake.testbed.oracle import PARTS, race_key

RID = race_key()
PARTS["raw_laps"] = "SELECT DISTINCT season, round FROM driven"

ASSERTION_SQL = {
    "A01": """
SELECT season, races_completed, races_scheduled, ifnull(n, 0) AS champions
FROM dim_season LEFT JOIN (SELECT season, count(*) FILTER (is_champion) AS n FROM fct_driver_standings GROUP BY season) c
  USING (season)
WHERE CASE WHEN races_completed = races_scheduled THEN ifnull(n, 0) <> 1 ELSE ifnull(n, 0) > 0 END""",
    "A02": """
SELECT championship, season, championship_position, count(*) AS entrants
FROM (SELECT 'drivers' AS championship, season, championship_position FROM stg_driver_standings
      UNION ALL SELECT 'constructors', season, championship_position FROM stg_constructor_standings)
WHERE championship_position IS NOT NULL GROUP BY ALL HAVING entrants > 1""",
    "A03": """
SELECT driver_id, replace(replace(name, 'age_', ''), '_days', '') AS record, value AS age_days
FROM (SELECT driver_id, COLUMNS('age_.*_days') FROM fct_driver_careers)
UNPIVOT (value FOR name IN (COLUMNS('age_.*_days'))) WHERE NOT (value BETWEEN 5840 AND 21960)""",
    "A04": """
WITH res AS (
  SELECT driver_id, count(DISTINCT race_id) AS starts, count(DISTINCT race_id) FILTER (is_win) AS wins,
         count(DISTINCT race_id) FILTER (is_podium) AS podiums
  FROM fct_race_results GROUP BY driver_id),
tit AS (SELECT driver_id, count(*) AS titles FROM fct_driver_standings WHERE is_champion GROUP BY driver_id)
SELECT r.driver_id, r.starts, c.starts AS career_starts, r.wins, c.wins AS career_wins, r.podiums,
       c.podiums AS career_podiums, ifnull(t.titles, 0) AS titles, c.titles AS career_titles
FROM res r LEFT JOIN tit t USING (driver_id) LEFT JOIN fct_driver_careers c USING (driver_id)
WHERE c.starts IS NULL OR (r.starts, r.wins, r.podiums, ifnull(t.titles, 0)) <> (c.starts, c.wins, c.podiums, c.titles)""",
    "A05": """
SELECT season, driver_id, championship_points, points_from_form
FROM stg_driver_standings
LEFT JOIN (SELECT season, driver_id, sum(points) AS points_from_form FROM int_driver_form GROUP BY ALL) USING (season, driver_id)
WHERE season > 1990 AND ifnull(points_from_form, 0) <> championship_points""",
    "A06": """
WITH paid AS (
  SELECT season, round, list_sum(ifnull(list_slice([25, 18, 15, 12, 10, 8, 6, 4, 2, 1], 1,
           count(*) FILTER (was_classified)), []))::BIGINT AS e
  FROM int_results_qualifying WHERE season > 1964 GROUP BY ALL),
got AS (SELECT season, round, sum(modern_points)::BIGINT AS a FROM int_driver_race WHERE season > 1964 GROUP BY ALL)
SELECT season, round, ifnull(e, 0)::BIGINT AS modern_points_expected, a AS modern_points_awarded
FROM paid LEFT JOIN got USING (season, round) WHERE ifnull(e, 0) IS DISTINCT FROM a""",
    "A07": """
SELECT season, round, winners
FROM (SELECT DISTINCT season, round FROM int_results_qualifying)
LEFT JOIN (SELECT season, round, count(*) FILTER (won) AS winners FROM int_driver_race GROUP BY ALL) USING (season, round)
WHERE ifnull(winners, 0) = 0 OR (season > 1957 AND winners > 1)""",
    "A08": """
WITH career AS (
  SELECT driver_id, race_id, row_number() OVER (PARTITION BY driver_id ORDER BY race_date, race_id)::INT AS n,
         MAP {'win': won, 'podium': podium, 'points': scored_points} AS hit
  FROM int_driver_race),
span AS (
  SELECT s.driver_id, streak_type, first_race_id, streak_length, f.n AS first_number, l.n AS last_number
  FROM fct_driver_streaks s LEFT JOIN career f ON f.driver_id = s.driver_id AND f.race_id = first_race_id
  LEFT JOIN career l ON l.driver_id = s.driver_id AND l.race_id = last_race_id),
measured AS (
  SELECT s.driver_id, streak_type, first_race_id, streak_length, first_number, last_number,
         last_number - first_number + 1 AS starts_spanned,
         CASE WHEN count(c.n) FILTER (c.n BETWEEN first_number AND last_number) > 0 THEN
           count(*) FILTER (c.n BETWEEN first_number AND last_number AND c.hit[streak_type]) END AS qualifying_inside,
         bool_or(c.hit[streak_type]) FILTER (c.n IN (first_number - 1, last_number + 1)) AS neighbour_qualifies
  FROM span s LEFT JOIN career c ON c.driver_id = s.driver_id
  GROUP BY ALL)
SELECT * FROM measured
WHERE first_number IS NULL OR last_number IS NULL OR starts_spanned <> streak_length
   OR ifnull(qualifying_inside, 0) <> streak_length OR ifnull(neighbour_qualifies, false)""",
    "A09": """
WITH want AS (
  SELECT driver_id, k AS streak_type, count(*) FILTER (CASE k WHEN 'win' THEN won WHEN 'podium' THEN podium ELSE scored_points END)
         AS qualifying_starts
  FROM int_driver_race, (VALUES ('win'), ('podium'), ('points')) kinds(k) GROUP BY ALL)
SELECT driver_id, streak_type, qualifying_starts, streak_starts
FROM want LEFT JOIN (SELECT driver_id, streak_type, sum(streak_length)::BIGINT AS streak_starts FROM fct_driver_streaks
                     GROUP BY ALL) USING (driver_id, streak_type)
WHERE qualifying_starts <> ifnull(streak_starts, 0)""",
    "A10": """
SELECT season, races_completed, races_scheduled, title_margin FROM dim_season
WHERE races_completed = races_scheduled AND NOT is_current_season AND NOT ifnull(title_margin >= 0, false)""",
    "A11": """
SELECT season, sprint_weekends_scheduled, sprints_completed FROM dim_season
WHERE races_completed = races_scheduled AND sprints_completed <> sprint_weekends_scheduled""",
    "A12": """
SELECT race_id, lap, position, count(*) AS drivers FROM fct_lap_positions
WHERE lap > 0 GROUP BY ALL HAVING drivers > 1""",
    "A13": f"""
WITH lap AS (SELECT race_id, driver_id, max(lap) AS last_lap FROM fct_lap_positions WHERE lap > 0 GROUP BY ALL),
res AS (
  SELECT race_id, driver_id, max(laps_completed) AS laps_completed FROM fct_race_results
  WHERE race_id IN (SELECT race_id FROM lap) GROUP BY ALL)
SELECT race_id, driver_id, laps_completed, last_lap
FROM (SELECT DISTINCT {RID} AS race_id FROM raw_laps) LEFT JOIN res USING (race_id) LEFT JOIN lap USING (race_id, driver_id)
WHERE driver_id IS NULL OR (laps_completed > 0 AND last_lap IS DISTINCT FROM laps_completed)""",
    "A14": f"""
SELECT race_id, driver_id, g AS grid_position, position
FROM (SELECT race_id, driver_id, min(grid_position) AS g FROM fct_race_results
      WHERE grid_position > 0 AND race_id IN (SELECT {RID} FROM raw_laps) GROUP BY ALL)
LEFT JOIN (SELECT race_id, driver_id, position FROM fct_lap_positions WHERE lap = 0) USING (race_id, driver_id)
WHERE position IS DISTINCT FROM g""",
    "A15": f"""
SELECT race_id, fastest_laps
FROM (SELECT DISTINCT {RID} AS race_id FROM stg_results WHERE fastest_lap_time IS NOT NULL)
LEFT JOIN (SELECT race_id, count(*) AS fastest_laps FROM fct_race_results WHERE is_fastest_lap GROUP BY race_id) USING (race_id)
WHERE fastest_laps IS DISTINCT FROM 1""",
    "A16": """
WITH texts AS (
  SELECT lap_time AS source_time, lap_time_seconds AS seconds FROM stg_laps
  UNION ALL SELECT duration, duration_seconds FROM stg_pit_stops
  UNION ALL SELECT q1_time, q1_seconds FROM stg_qualifying UNION ALL SELECT q2_time, q2_seconds FROM stg_qualifying
  UNION ALL SELECT q3_time, q3_seconds FROM stg_qualifying),
again AS (
  SELECT *, CASE WHEN regexp_full_match(source_time, '[0-9]+:[0-9]+[.][0-9]{3}')
                 THEN split_part(source_time, ':', 1)::INT * 60 + split_part(source_time, ':', 2)::DOUBLE
                 ELSE try_cast(source_time AS DOUBLE) END AS expected
  FROM texts)
SELECT source_time, seconds, count(*) AS n FROM again
WHERE round(seconds, 3) IS DISTINCT FROM round(expected, 3) GROUP BY ALL""",
    "A17": """
WITH lap AS (SELECT race_id, driver_id, max(lap) AS last_lap FROM fct_lap_positions WHERE lap > 0 GROUP BY ALL)
SELECT race_id, driver_id, stop_number, lap, last_lap
FROM fct_pit_stops LEFT JOIN lap USING (race_id, driver_id)
WHERE race_id IN (SELECT race_id FROM lap) AND NOT ifnull(lap <= last_lap, false)""",
    "A18": """
SELECT season, driver_id, points_scored, points_by_round
FROM fct_driver_standings
LEFT JOIN (SELECT race_id // 100 AS season, driver_id, sum(total_points) AS points_by_round FROM fct_points_by_round
           GROUP BY ALL) USING (season, driver_id)
WHERE abs(points_scored - ifnull(points_by_round, 0)) > 0.001""",
    "A19": """
SELECT season, driver_id, championship_points, points_scored, points_dropped FROM fct_driver_standings
WHERE season > 1990 AND points_dropped <> 0""",
    "A20": """
SELECT race_id, driver_id, qualifying_position, gap_seconds FROM fct_qualifying
WHERE gap_seconds < 0 OR (qualifying_position = 1 AND final_session_seconds IS NOT NULL AND gap_seconds IS DISTINCT FROM 0)""",
    "A21": f"""
SELECT race_id, pole_sitters
FROM (SELECT DISTINCT {RID} AS race_id FROM stg_qualifying)
LEFT JOIN (SELECT race_id, count(*) AS pole_sitters FROM fct_qualifying WHERE qualifying_position = 1 GROUP BY race_id)
  USING (race_id)
WHERE pole_sitters IS DISTINCT FROM 1""",
    "A22": """
SELECT season, driver_id, s.poles, p AS expected_poles, s.modern_points, m AS expected_modern_points
FROM fct_driver_standings s
LEFT JOIN (SELECT season, driver_id, count(*) FILTER (pole) AS p, sum(modern_points)::BIGINT AS m FROM int_driver_race
           GROUP BY ALL) USING (season, driver_id)
WHERE s.poles <> ifnull(p, 0) OR s.modern_points <> ifnull(m, 0)""",
    "A23": """
SELECT constructor_id, team_colour FROM seed_rows WHERE NOT regexp_full_match(team_colour, '#[0-9A-F]{6}')""",
    "A24": """
SELECT p.season, p.round, p.driver_id, p.teammate_id, session_compared,
       a.q1_seconds + b.q1_seconds IS NOT NULL AS both_q1, a.q2_seconds + b.q2_seconds IS NOT NULL AS both_q2,
       a.q3_seconds + b.q3_seconds IS NOT NULL AS both_q3
FROM int_teammate_qualifying p JOIN stg_qualifying a USING (season, round, driver_id)
JOIN stg_qualifying b ON b.season = p.season AND b.round = p.round AND b.driver_id = p.teammate_id
WHERE session_compared IS DISTINCT FROM CASE WHEN both_q3 THEN 'Q3' WHEN both_q2 THEN 'Q2' WHEN both_q1 THEN 'Q1' END""",
    "A25": """
SELECT season, round, constructor_id, rows_paired
FROM (SELECT season, round, constructor_id, count(*) AS cars FROM stg_qualifying GROUP BY ALL HAVING cars = 2)
FULL JOIN (SELECT season, round, constructor_id, count(*) AS rows_paired FROM int_teammate_qualifying GROUP BY ALL)
  USING (season, round, constructor_id)
WHERE cars IS NULL OR rows_paired IS DISTINCT FROM 2""",
    "A26": """
SELECT a.season, a.round, a.driver_id, a.teammate_id, a.session_compared, b.session_compared AS teammate_session_compared,
       a.gap_seconds, b.gap_seconds AS teammate_gap_seconds, a.beat_teammate, b.beat_teammate AS teammate_beat_teammate
FROM int_teammate_qualifying a LEFT JOIN int_teammate_qualifying b
  ON (a.season, a.round, a.constructor_id, a.driver_id, a.teammate_id)
   = (b.season, b.round, b.constructor_id, b.teammate_id, b.driver_id)
WHERE b.driver_id IS NULL OR a.session_compared IS DISTINCT FROM b.session_compared
   OR a.gap_seconds IS DISTINCT FROM -b.gap_seconds OR a.beat_teammate IS DISTINCT FROM (NOT b.beat_teammate)""",
    "A27": """
SELECT DISTINCT constructor_id FROM fct_teammate_qualifying
WHERE constructor_id NOT IN (SELECT constructor_id FROM team_colours)""",
    "A28": """
SELECT championship_position, championship_position_text
FROM (SELECT * FROM (SELECT championship_position, championship_position_text FROM stg_driver_standings)
      UNION ALL SELECT championship_position, championship_position_text FROM stg_constructor_standings)
WHERE (championship_position IS NULL) <> (NOT regexp_full_match(championship_position_text, '[0-9]+'))""",
}


@dataclass(frozen=True)
class Damage:
    """A change to one table, in expressions both engines understand."""

    table: str
    columns: dict[str, str] = field(default_factory=dict)
    where: str | None = None

    def spark(self, df: DataFrame) -> DataFrame:
        types = dict(df.dtypes)
        damaged = df.withColumns({c: F.expr(e).cast(types[c]) for c, e in self.columns.items()})
        return df.where(self.where) if self.where else damaged

    def sql(self) -> str:
        changes = ", ".join(f"{e} AS {c}" for c, e in self.columns.items())
        replaced = f" REPLACE ({changes})" if changes else ""
        return f"SELECT *{replaced} FROM {self.table}" + (f" WHERE {self.where}" if self.where else "")


DAMAGE = {
    "A01": Damage("fct_driver_standings", {"is_champion": "coalesce(championship_position <= 2, false)"}),
    "A02": Damage("stg_driver_standings",
                  {"championship_position": "CASE WHEN championship_position = 2 THEN 1 ELSE championship_position END"}),
    "A03": Damage("fct_driver_careers", {"age_first_win_days": "age_first_win_days - 9000"}),
    "A04": Damage("fct_driver_careers", {"wins": "CASE WHEN starts > 10 THEN wins + 1 ELSE wins END"}),
    "A05": Damage("int_driver_form", {"points": "CASE WHEN round = 3 THEN points + 1 ELSE points END"}),
    "A06": Damage("int_driver_race", {"modern_points": "CASE WHEN modern_points = 25 THEN 24 ELSE modern_points END"}),
    "A07": Damage("int_driver_race", {"won": "coalesce(best_finish_position <= 2, false)"}),
    "A08": Damage("fct_driver_streaks",
                  {"streak_length": "CASE WHEN streak_length > 1 THEN streak_length - 1 ELSE streak_length END"}),
    "A09": Damage("fct_driver_streaks", where="streak_length > 1"),
    "A10": Damage("dim_season", {"title_margin": "0 - title_margin - 1"}),
    "A11": Damage("dim_season", {"sprints_completed": "sprints_completed - 1"}),
    "A12": Damage("fct_lap_positions", {"position": "CASE WHEN position = 2 THEN 1 ELSE position END"}),
    "A13": Damage("fct_lap_positions", where="lap < 3"),
    "A14": Damage("fct_lap_positions", where="lap <> 0 OR position > 3"),
    "A15": Damage("fct_race_results", {"is_fastest_lap": "is_fastest_lap AND race_id % 2 = 0"}),
    "A16": Damage("stg_laps", {"lap_time_seconds": "CASE WHEN lap = 1 THEN lap_time_seconds + 1 ELSE lap_time_seconds END"}),
    "A17": Damage("fct_pit_stops", {"lap": "lap + 2"}),
    "A18": Damage("fct_points_by_round", {"total_points": "race_points"}),
    "A19": Damage("fct_driver_standings", {"points_dropped": "points_dropped + 1"}),
    "A20": Damage("fct_qualifying", {"gap_seconds": "gap_seconds - 1"}),
    "A21": Damage("fct_qualifying", where="qualifying_position > 1 OR race_id % 3 = 0"),
    "A22": Damage("fct_driver_standings", {"poles": "CASE WHEN poles > 0 THEN poles + 1 ELSE poles END"}),
    "A23": Damage("seed_rows", {"team_colour": "lower(team_colour)"}),
    "A24": Damage("int_teammate_qualifying", {"session_compared": "'Q1'"}),
    "A25": Damage("int_teammate_qualifying", where="qualifying_position > 20"),
    "A26": Damage("int_teammate_qualifying",
                  {"gap_seconds": "CASE WHEN driver_id < teammate_id THEN gap_seconds + 1 ELSE gap_seconds END"}),
    "A27": Damage("team_colours", where="constructor_id > 'h'"),
    "A28": Damage("stg_driver_standings", {"championship_position_text": "'R'"}),
}


def damaged_sql(name: str) -> str:
    """The assertion's SQL over the damaged table; what feeds that table stays whole."""
    damage = DAMAGE[name]
    part = f"damaged_{damage.table}"
    body = re.sub(rf"\b{damage.table}\b", part, ASSERTION_SQL[name])
    return f"WITH {part} AS ({damage.sql()}) SELECT * FROM ({body})"


# Declared checks ---------------------------------------------------------------
def _line(table: str, check: str, target: str, severity: str, count: str) -> str:
    return (f"SELECT '{table}' AS \"table\", '{check}' AS check_name, '{target}' AS target, "
            f"'{severity}' AS severity, ({count})::BIGINT AS violations")


def not_null_sql() -> list[str]:
    return [
        _line(t, "not_null", c, s, f"SELECT count(*) - count({c}) FROM {t}")
        for t, columns in quality.NOT_NULL.items() for c, s in columns.items()
    ]


def _duplicated(t: str, keys: tuple[str, ...], where: str = "") -> str:
    return f"SELECT count(*) FROM (SELECT 1 FROM {t} {where} GROUP BY {', '.join(keys)} HAVING count(*) > 1)"


def unique_sql() -> list[str]:
    return [
        _line(t, "unique", c, "error", _duplicated(t, (c,), f"WHERE {c} IS NOT NULL")) for t, c in quality.UNIQUE
    ]


def combination_sql() -> list[str]:
    return [
        _line(t, "unique_combination", ", ".join(keys), "error", _duplicated(t, keys))
        for t, keys in quality.COMBINATIONS.items()
    ]


def relationship_sql() -> list[str]:
    return [
        _line(t, "relationships", f"{c} in {p}", "error",
              f"SELECT count(*) FROM {t} x WHERE x.{c} IS NOT NULL AND NOT EXISTS (FROM {p} y WHERE y.{c} = x.{c})")
        for t, c, p in quality.RELATIONSHIPS
    ]


def accepted_sql() -> list[str]:
    return [
        _line(t, "accepted_values", c, "error",
              f"SELECT count(DISTINCT {c}) FROM {t} WHERE {c} NOT IN ({', '.join(repr(v) for v in values)})")
        for t, c, values in quality.ACCEPTED
    ]


def union(lines: list[str]) -> str:
    return "\nUNION ALL ".join(lines)

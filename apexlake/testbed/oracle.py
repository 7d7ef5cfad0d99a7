"""The projection and the models stated a second time, in DuckDB SQL, for the correctness check.

``PARTS`` maps a name to the body of a common table expression over the
provided tables. ``statement`` puts the parts a query needs in front of it.
"""

from __future__ import annotations

import re
from functools import lru_cache

from apexlake.sources.seed import team_colour_rows

# Functions of the projection -------------------------------------------------
TEAM_ID = """CASE {k} // 12 WHEN 0 THEN 'ferrari' WHEN 1 THEN 'mclaren' WHEN 2 THEN 'williams'
 WHEN 3 THEN 'red_bull' WHEN 4 THEN 'mercedes' WHEN 5 THEN 'haas' ELSE 'team_' || ({k} // 12) END"""
TEAM_NAME = "'Team ' || ({k} // 12) || CASE WHEN season >= 1998 THEN ' GP' ELSE '' END"
TEAM_NATION = "'NATION_' || ({k} // 12 % 25)"
CLOCK = "printf('%d:%02d.%03d', ({ms}) // 60000, ({ms}) // 1000 % 60, ({ms}) % 1000)"
CLOCK_SECONDS = "(({ms}) // 60000 * 60 + (({ms}) % 60000) / 1000.0::DOUBLE)"


def team_id(k: str = "ckey") -> str:
    return TEAM_ID.format(k=k)


def team_name(k: str = "ckey") -> str:
    return TEAM_NAME.format(k=k)


def team_nation(k: str = "ckey") -> str:
    return TEAM_NATION.format(k=k)


def clock(ms: str) -> str:
    return CLOCK.format(ms=ms)


def clock_seconds(ms: str) -> str:
    return CLOCK_SECONDS.format(ms=ms)


def race_key(season: str = "season", rnd: str = "round") -> str:
    return f"({season} * 100 + {rnd})::INT"


PARTS: dict[str, str] = {}

# Staging ---------------------------------------------------------------------
PARTS["src"] = """
SELECT year(o_orderdate)::INT AS season, month(o_orderdate)::INT AS round, o_orderkey AS okey,
       o_custkey AS ckey, o_orderstatus AS st, o_totalprice AS price, o_orderpriority AS prio
FROM orders"""
PARTS["cars"] = """
SELECT *, CASE WHEN st = 'P' OR finish > 60 THEN 0.0::DOUBLE ELSE (61 - finish) / 2.0::DOUBLE END AS points
FROM (SELECT *, row_number() OVER (PARTITION BY season, round ORDER BY st = 'P', price DESC, okey)::INT AS finish,
             row_number() OVER (PARTITION BY season, round ORDER BY okey % 97, okey)::INT AS slot
      FROM src)"""
PARTS["first_cars"] = "SELECT season, round, ckey, min(okey) AS okey FROM src GROUP BY ALL"
PARTS["calendar"] = """
SELECT season, unnest(range(1, 13))::INT AS round FROM (SELECT DISTINCT season FROM src)"""
PARTS["stg_races"] = """
WITH places AS (
  SELECT c.*, n_name, r_name, nk, make_date(season, round, 1) AS day
  FROM (SELECT *, (season * 12 + round) % 25 AS nk FROM calendar) c
  JOIN nation ON n_nationkey = nk JOIN region ON n_regionkey = r_regionkey)
SELECT season, round, 'Grand Prix of ' || n_name AS race_name, day AS race_date,
       CASE WHEN round % 4 <> 1 THEN day + INTERVAL 14 HOUR END AS race_start_utc,
       (day - 2) + INTERVAL 630 MINUTE AS fp1_start_utc,
       NULL::TIMESTAMP AS fp2_start_utc,
       CASE WHEN round % 2 = 0 THEN (day - 1) + INTERVAL 9 HOUR END AS fp3_start_utc,
       (day - 1) + INTERVAL 13 HOUR AS qualifying_start_utc,
       CASE WHEN round % 3 = 0 AND season >= 1997 THEN (day - 1) + INTERVAL 8 HOUR END AS sprint_start_utc,
       CASE WHEN round % 6 = 0 THEN (day - 2) + INTERVAL 15 HOUR END AS sprint_qualifying_start_utc,
       day - 2 AS fp1_date, day - 2 AS fp2_date,
       CASE WHEN round % 2 = 0 THEN day - 1 END AS fp3_date, day - 1 AS qualifying_date,
       CASE WHEN round % 3 = 0 THEN day - 1 END AS sprint_date,
       CASE WHEN round % 6 = 0 THEN day - 2 END AS sprint_qualifying_date,
       'circuit_' || nk AS circuit_id, 'Circuit ' || nk AS circuit_name, 'City ' || nk AS circuit_locality,
       r_name AS circuit_country, (nk * 3.25 - 40)::DOUBLE AS circuit_latitude,
       (nk * 7.5 - 90)::DOUBLE AS circuit_longitude,
       'https://example.org/' || season || '/' || round AS wikipedia_url
FROM places"""
PARTS["stg_results"] = f"""
WITH lines AS (SELECT okey AS l_orderkey, max(lap) AS n FROM driven GROUP BY ALL)
SELECT season, round, 'd' || ckey AS driver_id, {team_id()} AS constructor_id, {team_name()} AS constructor_name,
       {team_nation()} AS constructor_nationality, okey::INT AS car_number,
       CASE WHEN okey % 20 = 0 THEN 0 WHEN okey % 50 <> 7 THEN slot END::INT AS grid_position,
       finish AS finish_position, CASE WHEN st = 'P' THEN 'R' ELSE finish::VARCHAR END AS finish_position_text,
       points, coalesce(n, 0)::INT AS laps_completed,
       CASE st WHEN 'F' THEN 'Finished' WHEN 'O' THEN '+1 Lap' ELSE 'Retired' END AS status,
       CASE WHEN st <> 'P' THEN (5400000 + finish * 1000 + okey % 1000)::BIGINT END AS race_time_millis,
       CASE WHEN st = 'P' THEN NULL
            WHEN finish = 1 THEN printf('1:30:01.%03d', okey % 1000)
            ELSE printf('+%d.%03d', finish - 1, okey % 1000) END AS race_time,
       CASE WHEN season >= 1997 THEN slot END AS fastest_lap_rank,
       CASE WHEN season >= 1997 THEN (1 + okey % 50)::INT END AS fastest_lap_number,
       CASE WHEN season >= 1997 THEN {clock('85000 + slot * 37 + okey % 1000')} END AS fastest_lap_time,
       CASE WHEN season >= 1997 THEN {clock_seconds('85000 + slot * 37 + okey % 1000')} END AS fastest_lap_seconds,
       CASE WHEN season >= 1997 AND okey % 11 <> 0
            THEN ((200 + okey % 500 // 10) || '.' || (okey % 10))::DOUBLE END AS fastest_lap_avg_speed,
       CASE WHEN season >= 1997 AND okey % 11 <> 0 THEN 'kph' END AS fastest_lap_avg_speed_units
FROM cars LEFT JOIN lines ON okey = l_orderkey"""
PARTS["q_times"] = """
SELECT *, CASE WHEN okey % 50 <> 0 THEN 90000 + okey * 7 % 5000 END AS t1,
       CASE WHEN okey % 50 <> 0 AND okey % 3 <> 0 THEN 88000 + okey * 11 % 5000 END AS t2,
       CASE WHEN okey % 50 <> 0 AND okey % 3 = 1 THEN 87000 + okey * 13 % 5000 END AS t3
FROM first_cars"""
PARTS["stg_qualifying"] = f"""
SELECT season, round, 'd' || ckey AS driver_id, {team_id()} AS constructor_id, {team_name()} AS constructor_name,
       okey::INT AS car_number,
       row_number() OVER (PARTITION BY season, round
         ORDER BY t3 NULLS LAST, t2 NULLS LAST, t1 NULLS LAST, okey)::INT AS qualifying_position,
       CASE WHEN t1 IS NOT NULL THEN {clock('t1')} END AS q1_time, {clock_seconds('t1')} AS q1_seconds,
       CASE WHEN t2 IS NOT NULL THEN {clock('t2')} END AS q2_time, {clock_seconds('t2')} AS q2_seconds,
       CASE WHEN t3 IS NOT NULL THEN {clock('t3')} END AS q3_time, {clock_seconds('t3')} AS q3_seconds
FROM q_times"""
PARTS["stg_drivers"] = """
SELECT season, 'd' || ckey AS driver_id,
       CASE WHEN season BETWEEN 1998 AND 2000 THEN printf('C%03d', ckey % 1000) END AS driver_code,
       CASE WHEN season >= 1997 THEN (ckey % 100)::INT END AS permanent_number,
       split_part(c_name, '#', 1) AS given_name, split_part(c_name, '#', 2) AS family_name,
       replace(c_name, '#', ' ') AS full_name,
       CASE WHEN ckey % 50 <> 9 THEN make_date(CASE WHEN ckey % 100 = 3 THEN 1990 ELSE 1955 + ckey % 20 END,
         1 + ckey % 12, 1 + ckey % 28) END AS date_of_birth,
       n_name AS nationality, 'https://example.org/d/' || ckey AS wikipedia_url
FROM (SELECT DISTINCT season, ckey FROM src)
JOIN customer ON c_custkey = ckey JOIN nation ON n_nationkey = c_nationkey"""
PARTS["sprint_cars"] = """
SELECT season, round, ckey, okey, row_number() OVER (PARTITION BY season, round ORDER BY price DESC, okey)::INT AS finish
FROM (SELECT season, round + 1 AS round, ckey, min(okey) AS okey, arg_min(price, okey) AS price
      FROM src WHERE prio = '1-URGENT' AND round IN (2, 5, 8, 11) GROUP BY ALL)"""
PARTS["stg_sprint_results"] = f"""
SELECT season, round, 'd' || ckey AS driver_id, {team_id()} AS constructor_id, {team_name()} AS constructor_name,
       okey::INT AS car_number, (1 + okey % 20)::INT AS grid_position, finish AS finish_position,
       finish::VARCHAR AS finish_position_text, greatest(17 - finish, 0)::DOUBLE AS points,
       (10 + okey % 5)::INT AS laps_completed, 'Finished' AS status
FROM sprint_cars"""
PARTS["finals"] = "SELECT season, max(round) AS final_round FROM src GROUP BY season"
PARTS["stg_driver_standings"] = f"""
WITH per_race AS (
  SELECT season, ckey, round, sum(points) AS points, count(*) FILTER (finish = 1 AND st <> 'P') AS wins
  FROM cars GROUP BY ALL),
scored AS (
  SELECT season, ckey, wins, CASE WHEN season > 1997 OR
    row_number() OVER (PARTITION BY season, ckey ORDER BY points DESC, round) <= 2 THEN points ELSE 0 END AS points
  FROM per_race UNION ALL SELECT season, ckey, 0, greatest(17 - finish, 0) FROM sprint_cars),
totals AS (SELECT season, ckey, sum(points) AS total, sum(wins)::INT AS wins FROM scored GROUP BY ALL),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY season ORDER BY total DESC, wins DESC, ckey)::INT AS place FROM totals)
SELECT season, final_round, 'd' || ckey AS driver_id,
       CASE WHEN total > 0 AND ckey % 211 <> 7 THEN place END AS championship_position,
       CASE WHEN total = 0 THEN '-' WHEN ckey % 211 = 7 THEN 'D' ELSE place::VARCHAR END AS championship_position_text,
       total AS championship_points, wins,
       CASE WHEN ckey % 10 = 0 THEN [{team_id()}, {team_id('(ckey + 12)')}] ELSE [{team_id()}] END AS constructor_ids,
       CASE WHEN ckey % 10 = 0 THEN [{team_name()}, {team_name('(ckey + 12)')}] ELSE [{team_name()}] END
         AS constructor_names
FROM placed JOIN finals USING (season)"""
PARTS["stg_constructor_standings"] = f"""
WITH scored AS (
  SELECT season, ckey // 12 AS team, points, (finish = 1 AND st <> 'P')::INT AS wins FROM cars
  UNION ALL SELECT season, ckey // 12, greatest(17 - finish, 0), 0 FROM sprint_cars),
placed AS (
  SELECT season, team * 12 AS ckey, team, sum(points) AS total, sum(wins)::INT AS wins,
         row_number() OVER (PARTITION BY season ORDER BY sum(points) DESC, team)::INT AS place
  FROM scored GROUP BY season, team)
SELECT season, final_round, {team_id()} AS constructor_id, {team_name()} AS constructor_name,
       {team_nation()} AS constructor_nationality,
       CASE WHEN total > 0 AND team % 53 <> 5 THEN place END AS championship_position,
       CASE WHEN total = 0 THEN '-' WHEN team % 53 = 5 THEN 'E' ELSE place::VARCHAR END AS championship_position_text,
       total AS championship_points, wins
FROM placed JOIN finals USING (season)"""
PARTS["driven"] = """
SELECT *, row_number() OVER (PARTITION BY season, round, lap ORDER BY l_extendedprice DESC, okey)::INT AS place
FROM (SELECT season, round, ckey, okey, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_returnflag,
             row_number() OVER (PARTITION BY season, round, ckey ORDER BY okey, l_linenumber, l_partkey, l_suppkey,
               l_extendedprice, l_quantity, l_returnflag)::INT AS lap
      FROM lineitem JOIN src ON l_orderkey = okey)"""
LAP_MS = "80000 + (l_partkey * 31 + l_suppkey) % 20000"
PARTS["stg_laps"] = f"""
SELECT season, round, lap, 'd' || ckey AS driver_id, CASE WHEN l_partkey % 500 <> 0 THEN place END AS position,
       CASE WHEN l_partkey % 333 = 0 THEN 'no time' ELSE {clock(LAP_MS)} END AS lap_time,
       CASE WHEN l_partkey % 333 <> 0 THEN {clock_seconds(LAP_MS)} END AS lap_time_seconds
FROM driven"""
PARTS["stg_pit_stops"] = f"""
SELECT season, round, 'd' || ckey AS driver_id, row_number() OVER (PARTITION BY season, round, ckey ORDER BY lap)::INT AS stop_number,
       lap, printf('14:%02d:%02d', lap % 60, l_suppkey % 60) AS time_of_day,
       CASE WHEN ms >= 60000 THEN {clock('ms')} ELSE printf('%d.%03d', ms // 1000, ms % 1000) END AS duration,
       {clock_seconds('ms')} AS duration_seconds
FROM (SELECT *, 20000 + (l_quantity * 1000)::BIGINT + l_suppkey % 1000 AS ms FROM driven WHERE l_returnflag = 'R')"""

PARTS["team_colours"] = "SELECT * FROM (VALUES {}) AS t(constructor_id, team_colour, text_colour)".format(
    ", ".join("('" + "', '".join(row) + "')" for row in team_colour_rows())
)

# Intermediate ----------------------------------------------------------------
PARTS["int_results_qualifying"] = """
SELECT r.season, r.round, r.driver_id, r.car_number, constructor_id, constructor_name, race_name, race_date,
       race_start_utc, circuit_id, circuit_country, grid_position, finish_position, finish_position_text, points,
       laps_completed, status, race_time_millis, fastest_lap_rank, fastest_lap_number, fastest_lap_time,
       fastest_lap_seconds, q.qualifying_position, q.q1_seconds, q.q2_seconds, q.q3_seconds,
       list_min([q1_seconds, q2_seconds, q3_seconds]) AS best_qualifying_seconds,
       regexp_full_match(finish_position_text, '[0-9]+') AS was_classified,
       CASE WHEN grid_position > 0 AND regexp_full_match(finish_position_text, '[0-9]+')
            THEN grid_position - finish_position END AS positions_gained,
       CASE WHEN grid_position > 0 THEN grid_position - q.qualifying_position END AS grid_penalty_positions
FROM stg_results r
LEFT JOIN stg_races c USING (season, round)
LEFT JOIN (SELECT * EXCLUDE (constructor_id, constructor_name, car_number) FROM stg_qualifying) q
  USING (season, round, driver_id)"""
PARTS["int_driver_form"] = """
WITH cars_of AS (
  SELECT season, round, driver_id, sum(points) AS pts, min(finish_position) AS best, bool_or(was_classified) AS cls,
         min(grid_position) AS grid, count(*) AS n
  FROM int_results_qualifying GROUP BY ALL),
sprint_of AS (SELECT season, round, driver_id, sum(points) AS spts FROM stg_sprint_results GROUP BY ALL),
entry AS (
  SELECT season, round, driver_id, race_date, ifnull(pts, 0) AS race_points, ifnull(spts, 0) AS sprint_points,
         ifnull(pts, 0) + ifnull(spts, 0) AS points, best AS best_finish_position, ifnull(cls, false) AS was_classified,
         grid AS grid_position, ifnull(n, 0) AS cars_driven
  FROM cars_of FULL JOIN sprint_of USING (season, round, driver_id)
  LEFT JOIN (SELECT season, round, race_date FROM stg_races) USING (season, round))
SELECT season, round, driver_id, race_date, race_points, sprint_points, points, best_finish_position, was_classified,
       grid_position, cars_driven,
       count(*) OVER sofar AS career_races_to_date, sum(points) OVER sofar AS career_points_to_date,
       (count(*) FILTER (best_finish_position = 1) OVER sofar)::BIGINT AS career_wins_to_date,
       sum(points) OVER five AS points_last_5_races,
       round((avg(best_finish_position) FILTER (was_classified) OVER five)::DECIMAL(18, 6), 2)::DOUBLE
         AS avg_finish_last_5_races,
       sum(points) OVER before AS points_in_previous_5_races
FROM entry
WINDOW sofar AS (PARTITION BY driver_id ORDER BY race_date RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       five AS (PARTITION BY driver_id ORDER BY race_date, season, round ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
       before AS (PARTITION BY driver_id ORDER BY race_date, season, round ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"""
PARTS["int_driver_race"] = f"""
WITH start AS (
  SELECT season, round, driver_id, race_date, count(*) AS cars_driven, bool_or(was_classified) AS was_classified,
         min(finish_position) FILTER (was_classified) AS best_finish_position, min(grid_position) AS best_grid_position,
         sum(points) AS points
  FROM int_results_qualifying GROUP BY season, round, driver_id, race_date)
SELECT season, round, {race_key()} AS race_id, race_date, driver_id, date_of_birth,
       (race_date - date_of_birth)::INT AS age_days, cars_driven, was_classified, best_finish_position,
       best_grid_position, points,
       best_finish_position IS NOT DISTINCT FROM 1 AS won,
       ifnull(best_finish_position < 4, false) AS podium,
       best_grid_position IS NOT DISTINCT FROM 1 AS pole,
       points > 0 AS scored_points,
       ifnull([25, 18, 15, 12, 10, 8, 6, 4, 2, 1][best_finish_position], 0)::INT AS modern_points
FROM start LEFT JOIN (SELECT season, driver_id, date_of_birth FROM stg_drivers) USING (season, driver_id)"""
PARTS["int_teammate_qualifying"] = """
WITH team AS (
  SELECT *, count(*) OVER (PARTITION BY season, round, constructor_id) AS entries FROM stg_qualifying),
pair AS (
  SELECT a.season, a.round, a.constructor_id, a.driver_id, b.driver_id AS teammate_id,
         a.qualifying_position, b.qualifying_position AS teammate_qualifying_position,
         list_filter([{'s': 'Q3', 'a': a.q3_seconds, 'b': b.q3_seconds}, {'s': 'Q2', 'a': a.q2_seconds, 'b': b.q2_seconds},
                      {'s': 'Q1', 'a': a.q1_seconds, 'b': b.q1_seconds}],
                     lambda x: x.a IS NOT NULL AND x.b IS NOT NULL)[1] AS shared
  FROM team a JOIN team b USING (season, round, constructor_id)
  WHERE a.entries = 2 AND a.driver_id <> b.driver_id)
SELECT season, round, constructor_id, driver_id, teammate_id, qualifying_position, teammate_qualifying_position,
       shared.s AS session_compared, shared.a AS qualifying_seconds, shared.b AS teammate_qualifying_seconds,
       shared.a - shared.b AS gap_seconds, (shared.a - shared.b) / least(shared.a, shared.b) * 100 AS gap_pct,
       qualifying_position < teammate_qualifying_position AS beat_teammate
FROM pair"""

# Marts -----------------------------------------------------------------------
PARTS["dim_season"] = """
WITH lead AS (
  SELECT season, max(championship_points) FILTER (championship_position = 1)
               - max(championship_points) FILTER (championship_position = 2) AS title_margin
  FROM stg_driver_standings GROUP BY season)
SELECT season, count(*) AS races_scheduled,
       count(*) FILTER ((season, round) IN (SELECT (season, round) FROM stg_results)) AS races_completed,
       count(sprint_date) AS sprint_weekends_scheduled,
       count(*) FILTER ((season, round) IN (SELECT (season, round) FROM stg_sprint_results)) AS sprints_completed,
       min(race_date) AS first_race_date, max(race_date) AS last_race_date,
       season <= 1997 AS is_dropped_scores_era,
       season = (SELECT max(season) FROM stg_races) AS is_current_season,
       any_value(title_margin) AS title_margin
FROM stg_races LEFT JOIN lead USING (season) GROUP BY season"""
PARTS["dim_race"] = f"""
SELECT {race_key()} AS race_id, season, round, race_name,
       'R' || lpad(round::VARCHAR, 2, '0') || ' · ' || race_name AS race_label,
       race_date, race_start_utc, circuit_id, circuit_name, circuit_locality, circuit_country, circuit_latitude,
       circuit_longitude, EXISTS (FROM stg_results s WHERE s.season = r.season AND s.round = r.round) AS has_results,
       sprint_date IS NOT NULL AS is_sprint_weekend, wikipedia_url
FROM stg_races r"""
PARTS["dim_driver"] = """
SELECT driver_id, arg_max_null(full_name, season) AS driver_name, arg_max_null(given_name, season) AS given_name,
       arg_max_null(family_name, season) AS family_name, arg_max(driver_code, season) AS driver_code,
       arg_max(permanent_number, season) AS permanent_number, arg_max_null(date_of_birth, season) AS date_of_birth,
       arg_max_null(nationality, season) AS nationality, arg_max_null(wikipedia_url, season) AS wikipedia_url,
       min(season) AS first_season, max(season) AS last_season, count(*) AS seasons_entered
FROM stg_drivers GROUP BY driver_id"""
PARTS["dim_constructor"] = """
WITH newest AS (
  SELECT constructor_id, min(season) OVER team AS first_season, max(season) OVER team AS last_season,
         constructor_name, constructor_nationality
  FROM stg_results WINDOW team AS (PARTITION BY constructor_id)
  QUALIFY row_number() OVER (PARTITION BY constructor_id ORDER BY season DESC, round DESC, constructor_name DESC) = 1)
SELECT constructor_id, constructor_name, constructor_nationality, first_season, last_season,
       ifnull(team_colour, '#9E9E9E') AS team_colour, ifnull(text_colour, '#000000') AS text_colour
FROM newest LEFT JOIN team_colours USING (constructor_id)"""
PARTS["fct_race_results"] = f"""
SELECT {race_key()} AS race_id, driver_id, constructor_id, car_number, qualifying_position, best_qualifying_seconds,
       grid_position, finish_position, finish_position_text, was_classified, status, laps_completed, points,
       race_time_millis, fastest_lap_time, fastest_lap_number, fastest_lap_seconds, positions_gained,
       grid_penalty_positions, was_classified AND finish_position = 1 AS is_win,
       was_classified AND finish_position < 4 AS is_podium, points > 0 AS scored_points,
       fastest_lap_rank IS NOT DISTINCT FROM 1 AS is_fastest_lap
FROM int_results_qualifying"""
PARTS["fct_points_by_round"] = f"""
SELECT {race_key()} AS race_id, * EXCLUDE (season, round, race_date, points, grid_position, cars_driven),
       points AS total_points
FROM int_driver_form"""
PARTS["fct_driver_standings"] = """
WITH on_track AS (
  SELECT season, driver_id, count(DISTINCT round) AS races_entered, sum(points) AS rp,
         count(*) FILTER (was_classified AND finish_position = 1) AS race_wins,
         count(*) FILTER (was_classified AND finish_position < 4) AS podiums,
         count(*) FILTER (NOT was_classified) AS did_not_finish,
         round((avg(finish_position) FILTER (was_classified))::DECIMAL(18, 6), 2)::DOUBLE AS avg_finish_position,
         round(avg(grid_position)::DECIMAL(18, 6), 2)::DOUBLE AS avg_grid_position,
         sum(positions_gained)::BIGINT AS net_positions_gained
  FROM int_results_qualifying GROUP BY ALL),
starts_of AS (
  SELECT season, driver_id, count(*) FILTER (pole) AS poles, sum(modern_points)::BIGINT AS modern_points
  FROM int_driver_race GROUP BY ALL),
sprint_of AS (SELECT season, driver_id, sum(points) AS sp FROM stg_sprint_results GROUP BY ALL)
SELECT season, driver_id, array_to_string(constructor_names, ', ') AS constructor_names, championship_position,
       championship_position_text, championship_points, wins AS championship_wins,
       ifnull(championship_position = 1 AND races_completed = races_scheduled, false) AS is_champion,
       ifnull(rp, 0) + ifnull(sp, 0) AS points_scored, ifnull(rp, 0) AS race_points_scored,
       ifnull(sp, 0) AS sprint_points_scored,
       championship_points - (ifnull(rp, 0) + ifnull(sp, 0)) AS points_dropped,
       races_entered, race_wins, podiums, ifnull(poles, 0) AS poles, ifnull(modern_points, 0) AS modern_points,
       did_not_finish, avg_finish_position, avg_grid_position, net_positions_gained
FROM stg_driver_standings LEFT JOIN on_track USING (season, driver_id) LEFT JOIN starts_of USING (season, driver_id)
LEFT JOIN sprint_of USING (season, driver_id) LEFT JOIN dim_season USING (season)"""


def age(event: str, born: str = "date_of_birth") -> str:
    years = f"datesub('year', {born}, {event})"
    return f"({years} || 'y ' || ({event} - ({born} + to_years({years}::INT))::DATE) || 'd')"


MILESTONES = ["first_win", "last_win", "first_podium", "last_podium", "first_title", "last_title"]
PARTS["fct_driver_careers"] = """
WITH titles AS (
  SELECT driver_id, count(*) AS titles, min(d) AS first_title_date, max(d) AS last_title_date,
         min(season) AS first_title_season, max(season) AS last_title_season
  FROM fct_driver_standings JOIN (SELECT season, max(race_date) AS d FROM int_driver_race GROUP BY ALL) USING (season)
  WHERE is_champion GROUP BY driver_id),
career AS (
  SELECT driver_id, min(season) AS first_season, max(season) AS last_season, count(*) AS starts,
         count(*) FILTER (won) AS wins, count(*) FILTER (podium) AS podiums, count(*) FILTER (pole) AS poles,
         count(*) FILTER (scored_points) AS points_finishes, sum(modern_points)::BIGINT AS modern_points,
         min(race_date) FILTER (won) AS first_win_date, max(race_date) FILTER (won) AS last_win_date,
         min(race_date) FILTER (podium) AS first_podium_date, max(race_date) FILTER (podium) AS last_podium_date
  FROM int_driver_race GROUP BY driver_id)
SELECT driver_id, first_season, last_season, starts, wins, podiums, poles, points_finishes,
       ifnull(titles, 0) AS titles, wins / starts AS win_rate, podiums / starts AS podium_rate,
       poles / starts AS pole_rate, modern_points, modern_points / starts AS modern_points_per_start,
       first_win_date, last_win_date, first_podium_date, last_podium_date, first_title_season, last_title_season, {}
FROM career LEFT JOIN titles USING (driver_id)
LEFT JOIN (SELECT driver_id, date_of_birth FROM dim_driver) USING (driver_id)""".format(", ".join(
    [f"({m}_date - date_of_birth)::INT AS age_{m}_days" for m in MILESTONES]
    + [f"{age(m + '_date')} AS age_{m}" for m in MILESTONES]
))
PARTS["fct_driver_streaks"] = f"""
WITH tried AS (
  SELECT driver_id, race_id, race_date, unnest(['win', 'podium', 'points']) AS streak_type,
         ifnull(unnest([won, podium, scored_points]), false) AS hit
  FROM int_driver_race),
misses AS (
  SELECT *, sum((NOT hit)::INT) OVER (so_far ORDER BY race_date, race_id) AS missed,
         sum((NOT hit)::INT) OVER so_far AS missed_in_all
  FROM tried WINDOW so_far AS (PARTITION BY driver_id, streak_type)),
streaks AS (
  SELECT driver_id, streak_type, count(*) AS streak_length, first(race_id ORDER BY race_date, race_id) AS first_race_id,
         last(race_id ORDER BY race_date, race_id) AS last_race_id, min(race_date) AS first_race_date,
         max(race_date) AS last_race_date, missed = missed_in_all AS runs_to_latest_start
  FROM misses WHERE hit GROUP BY driver_id, streak_type, missed, missed_in_all),
names AS (SELECT {race_key()} AS race_id, season || ' ' || race_name AS label FROM stg_races)
SELECT driver_id, streak_type, streak_length,
       rank() OVER (PARTITION BY streak_type ORDER BY streak_length DESC)::INT AS streak_rank,
       first_race_id, last_race_id, first_race_date, last_race_date, f.label AS first_race, l.label AS last_race,
       runs_to_latest_start
FROM streaks LEFT JOIN names f ON f.race_id = first_race_id LEFT JOIN names l ON l.race_id = last_race_id"""
PARTS["fct_qualifying"] = f"""
WITH timed AS (
  SELECT *, CASE WHEN season = 1996 AND q1_seconds + q2_seconds IS NOT NULL
                 THEN {{'s': 'Aggregate', 't': q1_seconds + q2_seconds}}
                 WHEN q3_seconds IS NOT NULL THEN {{'s': 'Q3', 't': q3_seconds}}
                 WHEN q2_seconds IS NOT NULL THEN {{'s': 'Q2', 't': q2_seconds}}
                 WHEN q1_seconds IS NOT NULL THEN {{'s': 'Q1', 't': q1_seconds}} END AS final
  FROM stg_qualifying),
grid AS (SELECT season, round, driver_id, min(grid_position) AS grid_position FROM int_results_qualifying GROUP BY ALL)
SELECT {race_key('t.season', 't.round')} AS race_id, t.driver_id, constructor_id, qualifying_position,
       q1_time, q2_time, q3_time, q1_seconds, q2_seconds, q3_seconds,
       list_min([q1_seconds, q2_seconds, q3_seconds]) AS best_qualifying_seconds, final.t AS final_session_seconds,
       final.t - min(final.t) OVER (PARTITION BY t.season, t.round, final.s) AS gap_seconds,
       CASE WHEN t.season >= 1998 THEN final.s END AS final_session, grid_position
FROM timed t LEFT JOIN grid USING (season, round, driver_id)"""
PARTS["fct_lap_positions"] = f"""
WITH stopped AS (SELECT DISTINCT season, round, driver_id, lap, true AS in_pits FROM stg_pit_stops),
covered AS (SELECT DISTINCT season, round FROM stg_laps)
SELECT {race_key()} AS race_id, driver_id, lap, position, lap_time_seconds, ifnull(in_pits, false) AS is_pit_lap
FROM stg_laps LEFT JOIN stopped USING (season, round, driver_id, lap) WHERE position IS NOT NULL
UNION ALL
SELECT {race_key()}, driver_id, 0, min(grid_position), NULL, false
FROM int_results_qualifying JOIN covered USING (season, round)
WHERE grid_position > 0
GROUP BY season, round, driver_id"""
PARTS["fct_pit_stops"] = f"""
SELECT {race_key()} AS race_id, driver_id, stop_number, lap, time_of_day, duration_seconds FROM stg_pit_stops"""
PARTS["fct_teammate_qualifying"] = f"""
SELECT {race_key()} AS race_id, p.driver_id, constructor_id, teammate_id, driver_name AS teammate_name,
       qualifying_position, teammate_qualifying_position, beat_teammate, session_compared, qualifying_seconds,
       teammate_qualifying_seconds, gap_seconds, gap_pct
FROM int_teammate_qualifying p LEFT JOIN dim_driver d ON d.driver_id = teammate_id"""


@lru_cache(maxsize=None)
def needs(body: str) -> tuple[str, ...]:
    """Parts a statement refers to, in the order they must be stated."""
    found: dict[str, None] = {}
    for word in dict.fromkeys(re.findall(r"\b[a-z_0-9]+\b", body)):
        if word in PARTS:
            found.update(dict.fromkeys([*needs(PARTS[word]), word]))
    return tuple(found)


def statement(body: str) -> str:
    parts = needs(body)
    if not parts:
        return body
    stated = "WITH " + ",\n".join(f"{name} AS ({PARTS[name]})" for name in parts)
    body = body.strip()
    return stated + (",\n" + body[len("WITH"):] if body.startswith("WITH ") else "\n" + body)


def select(name: str) -> str:
    return statement(f"SELECT * FROM {name}")

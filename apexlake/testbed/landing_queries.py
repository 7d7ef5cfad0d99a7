"""Landing, planning and watermark queries over the pages made from the test tables, with their SQL."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apexlake.plans.warehouse import Warehouse
from apexlake.session import shared_folder
from apexlake.sources import landing, planning
from apexlake.sources.landing import RawTable
from apexlake.sources.planning import LoadState
from apexlake.sources.runs import failed_scopes, land
from apexlake.streaming.landing import incoming_schema, land_new_files
from apexlake.testbed.build import LANDED_AT
from apexlake.testbed.oracle import PARTS

SEASONAL = [name for name, _, _, per_race in planning.ENDPOINTS if not per_race]
PAGED = [name for name, _, _, _ in planning.ENDPOINTS]
NEWEST = (2001, 9)  # the ninth round of 2001 has been run but not published


def _spark(w: Warehouse) -> SparkSession:
    return w.colours.sparkSession


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _pages(w: Warehouse, endpoints: list[str]) -> DataFrame:
    return _stack([w.raw[e].withColumn("endpoint", F.lit(e)) for e in endpoints])


def _latest(w: Warehouse) -> DataFrame:
    return _spark(w).createDataFrame([NEWEST], "season int, latest_round int")


def _state(w: Warehouse) -> DataFrame:
    """Everything loaded, but 2001 results only through round 5 and qualifying of 2000 never."""
    none = _spark(w).createDataFrame([], "season int, latest_round int")
    seasons = w.table("stg_races").select("season").distinct()
    full = _stack([planning.season_watermarks(e, seasons, w.raw[e], none) for e in SEASONAL])
    stale = (F.col("endpoint") == "results") & (F.col("season") == NEWEST[0])
    never = (F.col("endpoint") == "qualifying") & (F.col("season") == 2000)
    return full.where(~never).withColumn("last_round", F.when(stale, 5).otherwise(F.col("last_round"))).withColumn(
        "loaded_at", F.lit(LANDED_AT).cast("timestamp")
    )


def _covered(w: Warehouse) -> DataFrame:
    return planning.coverage(w.table("stg_races").select("season").distinct(), planning.registry(_spark(w)))


def row_count(w: Warehouse) -> DataFrame:
    """L6."""
    rows = landing.rows_on_page(F.col("page_limit"), F.col("total_rows"), F.col("page_offset"))
    return _pages(w, PAGED).select("endpoint", "season", "round", "page_offset", rows.alias("rows_on_page"))


def page_plan(w: Warehouse) -> DataFrame:
    """L7."""
    scopes = _pages(w, PAGED).select("endpoint", "season", "round", "total_rows").distinct()
    return landing.page_plan(scopes)


def missing(w: Warehouse) -> DataFrame:
    """Planned pages that never arrived: one in seven, spread over all scopes, is held back here."""
    scope = ["endpoint", "season", "round"]
    arrived = _pages(w, PAGED).withColumn("round", F.coalesce("round", F.lit(0)))
    # The first page of a scope stays, as it tells how many there are.
    lost = (F.col("page_offset") > 0) & ((F.col("season") + 3 * F.col("round") + F.col("page_offset") / 100) % 7 == 2)
    return landing.missing_pages(arrived.where(~lost), scope)


def max_round(w: Warehouse) -> DataFrame:
    """L8."""
    pages = _pages(w, SEASONAL).withColumn("highest", landing.highest_round(F.col("payload")))
    return pages.groupBy("endpoint", "season").agg(F.max("highest").alias("max_round"))


def coverage(w: Warehouse) -> DataFrame:
    """L9."""
    return _covered(w).select("season", "endpoint")


def latest_race(w: Warehouse) -> DataFrame:
    """L10."""
    return planning.latest_completed_race(w.table("stg_results"))


def calendar(w: Warehouse) -> DataFrame:
    """L11."""
    return planning.season_calendar(w.table("stg_races"))


def load_plan(w: Warehouse) -> DataFrame:
    """L12 and L13."""
    return planning.load_plan(_covered(w), _state(w), _latest(w))


def load_plan_forced(w: Warehouse) -> DataFrame:
    return planning.load_plan(_covered(w), _state(w), _latest(w), force=True)


def _race_state(w: Warehouse, endpoint: str) -> DataFrame:
    """Complete up to 1999, in progress through round 4 of 2000."""
    seasons = w.table("stg_races").groupBy("season").agg(F.max("round").alias("last_round"))
    done = seasons.where(F.col("season") < 2000).withColumn("endpoint", F.lit(endpoint))
    part = seasons.where(F.col("season") == 2000).select(
        "season", F.lit(4).alias("last_round"), F.lit(f"{endpoint}_progress").alias("endpoint")
    )
    return done.unionByName(part)


def resume_plan(w: Warehouse) -> DataFrame:
    """L14, for both endpoints loaded by race."""
    return _stack([
        planning.resume_plan(w.table("stg_races"), _race_state(w, e), _latest(w), e).withColumn("endpoint", F.lit(e))
        for e in planning.PER_RACE
    ])


def _outcomes(w: Warehouse, endpoint: str) -> DataFrame:
    planned = planning.resume_plan(w.table("stg_races"), _race_state(w, endpoint), _latest(w), endpoint, force=True)
    return planning.round_outcomes(planned, w.raw[endpoint], _latest(w))


def outcomes(w: Warehouse) -> DataFrame:
    """L15."""
    return _stack([_outcomes(w, e).withColumn("endpoint", F.lit(e)) for e in planning.PER_RACE])


def season_watermarks(w: Warehouse) -> DataFrame:
    """The current season takes the round given, the others the payload's."""
    seasons = w.table("stg_races").select("season").distinct()
    return _stack([planning.season_watermarks(e, seasons, w.raw[e], _latest(w)) for e in SEASONAL])


def race_progress(w: Warehouse) -> DataFrame:
    """L17."""
    return _stack([planning.race_progress(e, _outcomes(w, e)) for e in planning.PER_RACE])


def race_watermarks(w: Warehouse) -> DataFrame:
    """The season with a round unpublished gets progress but no completion."""
    return _stack([planning.race_watermarks(e, _outcomes(w, e)) for e in planning.PER_RACE])


def upsert(w: Warehouse) -> DataFrame:
    """L18."""
    fresh = season_watermarks(w).where(F.col("season") >= 2000)
    return planning.upsert_watermarks(_state(w), fresh, F.lit("2001-09-08 06:00:00").cast("timestamp"))


def state_round_trip(w: Warehouse) -> DataFrame:
    """L18 and L19 through the stored table: create, write, replace, read."""
    state = LoadState(_spark(w), f"{shared_folder(_spark(w))}/state-{uuid.uuid4().hex}")
    state.create()
    state.upsert(_state(w).drop("loaded_at"))
    state.upsert(season_watermarks(w).where(F.col("season") >= 2000))
    return state.read().select("endpoint", "season", "last_round", "total_rows")


def _broken(w: Warehouse) -> DataFrame:
    """Pages cut short in transit: the second page of every results season."""
    cut = F.expr("substring(payload, 1, 40)")
    return w.raw["results"].withColumn("payload", F.when(F.col("page_offset") == 100, cut).otherwise(F.col("payload")))


def rejects(w: Warehouse) -> DataFrame:
    """L23."""
    return landing.validate(_broken(w))[1].select("season", "page_offset", "total_rows")


def failures(w: Warehouse) -> DataFrame:
    """L20."""
    return failed_scopes(_broken(w), ["season"])


def summary(w: Warehouse) -> DataFrame:
    """L21."""
    failed = failures(w).withColumn("endpoint", F.lit("results"))
    loaded = season_watermarks(w).where(F.col("endpoint") != "results")
    out = planning.run_summary(loaded, failed)
    return out.select(
        "loaded", "source_rows", F.array_join("endpoint_seasons", ", ").alias("endpoint_seasons"),
        F.array_join("failures", ", ").alias("failures"),
    )


def spine(w: Warehouse) -> DataFrame:
    """From the first season in the results to the newest."""
    edge = w.table("stg_results").agg(F.min("season").alias("a"), F.max("season").alias("b")).first()
    return planning.season_spine(_spark(w), edge["a"], edge["b"])


def _copy(w: Warehouse, endpoint: str) -> RawTable:
    """The endpoint's pages landed once more, in a table of their own."""
    table = RawTable(
        _spark(w), f"{shared_folder(_spark(w))}/copy-{uuid.uuid4().hex}", per_race=endpoint in planning.PER_RACE
    )
    pages = w.raw[endpoint]
    table.replace(pages, pages, "first", F.lit(LANDED_AT).cast("timestamp"))
    return table


def replace_season(w: Warehouse) -> DataFrame:
    """1997 comes back with other pages, 1998 comes back empty, the rest stays."""
    table = _copy(w, "results")
    # The pages of 1999 under the name of 1997.
    again = table.read().where(F.col("season") == 1999).withColumn("season", F.lit(1997))
    requested = _spark(w).createDataFrame([(1997,), (1998,)], "season int")
    table.replace(again, requested, "second", F.lit("2001-09-08 06:00:00").cast("timestamp"))
    return table.read().groupBy("season", "ingested_at").agg(F.count("*").alias("pages"))


def replace_race(w: Warehouse) -> DataFrame:
    """L2, L4: one race comes back empty; its neighbours stay."""
    table = _copy(w, "laps")
    requested = _spark(w).createDataFrame([(1999, 7)], "season int, round int")
    table.replace(table.read().limit(0), requested, "second", F.lit("2001-09-08 06:00:00").cast("timestamp"))
    return table.read().groupBy("season", "round").agg(F.count("*").alias("pages"))


def _streamed(w: Warehouse, endpoint: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Pages landed by a stream from files, with a second run that finds nothing new; and the watermarks."""
    spark = _spark(w)
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    table = RawTable(spark, f"{root}/raw", per_race=endpoint in planning.PER_RACE)
    state = LoadState(spark, f"{root}/state")
    state.create()
    w.raw[endpoint].select(*[f.name for f in incoming_schema(table)]).write.json(f"{root}/incoming")
    for _ in range(2):
        land_new_files(
            spark, endpoint, f"{root}/incoming", table, state, _latest(w), f"{root}/checkpoint"
        ).awaitTermination()
    return table.read().groupBy(*columns).agg(F.count("*").alias("pages")), state.read()


class _Streams:
    """Season pages of results fed by several streams, each with files and a checkpoint of its own, and by hand."""

    def __init__(self, w: Warehouse):
        self.w, self.root = w, f"{shared_folder(_spark(w))}/streams-{uuid.uuid4().hex}"
        self.table, self.state = RawTable(_spark(w), f"{self.root}/raw"), LoadState(_spark(w), f"{self.root}/state")
        self.state.create()

    def pages(self, source: str) -> DataFrame:
        names = [f.name for f in incoming_schema(self.table)]
        return self.w.raw["results"].withColumn("request_url", F.lit(source)).select(*names)

    def deliver(self, pages: DataFrame, stream: str) -> None:
        pages.write.mode("append").json(f"{self.root}/{stream}/incoming")
        land_new_files(
            _spark(self.w), "results", f"{self.root}/{stream}/incoming", self.table, self.state, _latest(self.w),
            f"{self.root}/{stream}/checkpoint").awaitTermination()

    def shown(self, *sources: str) -> DataFrame:
        return self.table.read().groupBy("season").agg(
            F.count("*").alias("pages"), *[F.count_if(F.col("request_url") == x).alias(x) for x in sources])


def stream_new_checkpoint(w: Warehouse) -> DataFrame:
    """A second stream, whose batches count from 0 again, brings newer pages of even seasons."""
    streams = _Streams(w)
    streams.deliver(streams.pages("first"), "first")
    streams.deliver(streams.pages("second").where("season % 2 = 0"), "second")
    return streams.shown("first", "second")


def stream_after_load(w: Warehouse) -> DataFrame:
    """After a load by hand a stream's part of a scope changes nothing; a whole one does."""
    streams = _Streams(w)
    streams.deliver(streams.pages("stream"), "first")
    by_hand = streams.pages("hand").where("season % 2 = 1")
    land("results", streams.table, streams.state, by_hand, by_hand, _latest(w), "hand")
    streams.deliver(streams.pages("late").where("page_offset = 0"), "first")
    return streams.shown("stream", "hand", "late")


def stream(w: Warehouse) -> DataFrame:
    """L27 for an endpoint loaded by season."""
    landed, marks = _streamed(w, "results", ["season"])
    return landed.join(marks, "season").select("season", "pages", "last_round", "total_rows")


def stream_races(w: Warehouse) -> DataFrame:
    """L27 for an endpoint loaded by race; the watermarks are those of the whole seasons."""
    landed, marks = _streamed(w, "pit_stops", ["season", "round"])
    done = marks.where(F.col("endpoint") == "pit_stops")
    return landed.join(done, "season").select("season", "round", "pages", "last_round", "total_rows")


def run_isolated(w: Warehouse) -> DataFrame:
    """L20 end to end: seasons with an unreadable page keep no watermark, the others load."""
    spark = _spark(w)
    root = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    table, state = RawTable(spark, f"{root}/raw"), LoadState(spark, f"{root}/state")
    state.create()
    cut = F.expr("substring(payload, 1, 40)")
    odd = (F.col("page_offset") == 100) & (F.col("season") % 2 == 1)
    pages = w.raw["results"].withColumn("payload", F.when(odd, cut).otherwise(F.col("payload")))
    land("results", table, state, pages, pages, _latest(w), "run")
    loaded = state.read().where(F.col("endpoint") == "results").select("season", "last_round", "total_rows")
    return table.read().groupBy("season").agg(F.count("*").alias("pages")).join(loaded, "season", "full_outer")


# SQL ---------------------------------------------------------------------------------
_SEASON_TABLES = {
    "races": "stg_races", "results": "stg_results", "qualifying": "stg_qualifying", "drivers": "stg_drivers",
    "driver_standings": "stg_driver_standings", "constructor_standings": "stg_constructor_standings",
    "sprint": "stg_sprint_results",
}
_RACE_TABLES = {"laps": "stg_laps", "pit_stops": "stg_pit_stops"}
PARTS["land_totals"] = " UNION ALL ".join(
    [f"SELECT '{e}' AS endpoint, season, NULL::INT AS round, count(*)::INT AS total_rows FROM {t} GROUP BY season"
     for e, t in _SEASON_TABLES.items()]
    + [f"SELECT '{e}', season, round, count(*)::INT FROM {t} GROUP BY season, round" for e, t in _RACE_TABLES.items()]
)
PARTS["land_pages"] = """
SELECT endpoint, season, round, total_rows, unnest(range(0, total_rows, 100))::INT AS page_offset FROM land_totals"""
PARTS["land_rounds"] = " UNION ALL ".join(
    f"SELECT '{e}' AS endpoint, season, {'max(round)' if e in ('races', 'results', 'qualifying', 'sprint') else 'NULL::INT'}"
    f" AS max_round FROM {t} GROUP BY season" for e, t in _SEASON_TABLES.items()
)
PARTS["land_seasons"] = "SELECT DISTINCT season FROM src"
PARTS["land_registry"] = "SELECT * FROM (VALUES {}) AS r(endpoint, first_season)".format(
    ", ".join(f"('{name}', {first})" for name, _, first, _ in planning.ENDPOINTS)
)
PARTS["land_covered"] = """
SELECT season, endpoint FROM land_seasons JOIN land_registry ON season >= first_season"""
PARTS["land_full"] = """
SELECT endpoint, season, max_round AS last_round, ifnull(total_rows, 0)::INT AS total_rows
FROM (SELECT endpoint, season FROM land_seasons, (SELECT DISTINCT endpoint FROM land_rounds))
LEFT JOIN land_rounds USING (endpoint, season) LEFT JOIN land_totals USING (endpoint, season)"""
PARTS["land_state"] = """
SELECT endpoint, season, CASE WHEN endpoint = 'results' AND season = 2001 THEN 5 ELSE last_round END AS last_round,
       total_rows
FROM land_full WHERE NOT (endpoint = 'qualifying' AND season = 2000)"""
PARTS["land_marks"] = """
SELECT endpoint, season, CASE WHEN season = 2001 THEN 9 ELSE last_round END AS last_round, total_rows FROM land_full"""
PARTS["land_outcomes"] = """
SELECT endpoint, season, round, ifnull(total_rows, 0)::INT AS total_rows,
       CASE WHEN total_rows IS NOT NULL THEN 'landed' WHEN season = 2001 AND round = 9 THEN 'unpublished'
            ELSE 'absent' END AS outcome
FROM (SELECT endpoint, season, round FROM stg_races, (VALUES ('laps'), ('pit_stops')) AS e(endpoint) WHERE season < 2001 OR round <= 9)
LEFT JOIN land_totals USING (endpoint, season, round)"""
PARTS["land_progress"] = """
SELECT endpoint || '_progress' AS endpoint, season, round AS last_round,
       (sum(total_rows) OVER (PARTITION BY endpoint, season ORDER BY round))::INT AS total_rows
FROM land_outcomes WHERE outcome <> 'unpublished'"""
PARTS["land_newest"] = """
SELECT endpoint, season, last_round, total_rows FROM land_progress
QUALIFY row_number() OVER (PARTITION BY endpoint, season ORDER BY last_round DESC) = 1"""
_UPSERT = """
SELECT endpoint, season, last_round, total_rows{old} FROM land_state WHERE season < 2000
UNION ALL SELECT endpoint, season, last_round, total_rows{new} FROM land_marks WHERE season >= 2000"""
_RESULT_PAGES = "(SELECT season, count(*) AS n, max(page_offset) AS top FROM land_pages WHERE endpoint = 'results' GROUP BY season)"

QUERIES = {
    "land_row_count": (row_count, """
SELECT endpoint, season, round, page_offset, least(100, total_rows - page_offset) AS rows_on_page FROM land_pages"""),
    "land_page_plan": (page_plan, "SELECT *, 100 AS page_limit FROM land_pages"),
    "land_missing_pages": (missing, """
SELECT endpoint, season, ifnull(round, 0) AS round, page_offset FROM land_pages
WHERE page_offset > 0 AND (season + 3 * ifnull(round, 0) + page_offset // 100) % 7 = 2"""),
    "land_max_round": (max_round, "SELECT * FROM land_rounds"),
    "land_coverage": (coverage, "SELECT * FROM land_covered"),
    "land_latest_race": (latest_race, """
SELECT season, max(round) AS latest_round FROM src WHERE season = (SELECT max(season) FROM src) GROUP BY season"""),
    "land_calendar": (calendar, "SELECT season, round FROM calendar"),
    "land_plan": (load_plan, """
SELECT season, endpoint FROM land_covered c
WHERE NOT EXISTS (FROM land_state s WHERE s.season = c.season AND s.endpoint = c.endpoint
                  AND (s.season < 2001 OR ifnull(s.last_round >= 9, false)))"""),
    "land_plan_forced": (load_plan_forced, "SELECT * FROM land_covered"),
    "land_resume_plan": (resume_plan, """
SELECT endpoint, season, round FROM calendar, (VALUES ('laps'), ('pit_stops')) AS e(endpoint)
WHERE (season = 2000 AND round > 4) OR (season = 2001 AND round <= 9)"""),
    "land_outcomes": (outcomes, "SELECT * FROM land_outcomes"),
    "land_season_watermarks": (season_watermarks, "SELECT * FROM land_marks"),
    "land_race_progress": (race_progress, "SELECT * FROM land_progress"),
    "land_race_watermarks": (race_watermarks, """
SELECT * FROM land_newest
UNION ALL SELECT replace(endpoint, '_progress', ''), season, last_round, total_rows FROM land_newest n
WHERE NOT EXISTS (FROM land_outcomes o WHERE outcome = 'unpublished' AND n.endpoint = o.endpoint || '_progress' AND n.season = o.season)"""),
    "land_upsert": (upsert, _UPSERT.format(
        old=f", TIMESTAMP '{LANDED_AT}' AS loaded_at", new=", TIMESTAMP '2001-09-08 06:00:00'")),
    "land_state_round_trip": (state_round_trip, _UPSERT.format(old="", new="")),
    "land_rejects": (rejects, """
SELECT season, page_offset, total_rows FROM land_pages WHERE endpoint = 'results' AND page_offset = 100"""),
    "land_failures": (failures, """
SELECT season, 'unreadable page' AS reason FROM land_pages WHERE endpoint = 'results' AND page_offset = 100"""),
    "land_summary": (summary, """
SELECT (SELECT count(*) FROM land_marks WHERE endpoint <> 'results') AS loaded,
       (SELECT sum(total_rows)::BIGINT FROM land_marks WHERE endpoint <> 'results') AS source_rows,
       (SELECT string_agg(season || ' ' || endpoint, ', ' ORDER BY season || ' ' || endpoint) FROM land_marks
        WHERE endpoint <> 'results') AS endpoint_seasons,
       (SELECT ifnull(string_agg(season || ' results: unreadable page', ', ' ORDER BY season), '') FROM land_pages
        WHERE endpoint = 'results' AND page_offset = 100) AS failures"""),
    "land_season_spine": (spine, "SELECT unnest(range(min(season), max(season) + 1))::INT AS season FROM src"),
    "land_replace_season": (replace_season, f"""
SELECT season, CASE WHEN season = 1997 THEN TIMESTAMP '2001-09-08 06:00:00' ELSE TIMESTAMP '{LANDED_AT}' END AS ingested_at,
       count(*) AS pages
FROM (SELECT season FROM land_pages WHERE endpoint = 'results' AND season NOT IN (1997, 1998)
      UNION ALL SELECT 1997 FROM land_pages WHERE endpoint = 'results' AND season = 1999)
GROUP BY season"""),
    "land_replace_race": (replace_race, """
SELECT season, round, count(*) AS pages FROM land_pages
WHERE endpoint = 'laps' AND NOT (season = 1999 AND round = 7) GROUP BY ALL"""),
    "land_run_isolated": (run_isolated, f"""
SELECT season, n AS pages, CASE WHEN season = 2001 THEN 9 ELSE last_round END AS last_round, total_rows
FROM {_RESULT_PAGES} JOIN (FROM land_full WHERE endpoint = 'results') USING (season)
WHERE season % 2 = 0 OR top < 100"""),
    "land_stream_races": (stream_races, """
SELECT season, round, count(*) AS pages, last_round, season_rows AS total_rows
FROM land_pages JOIN (
  SELECT season, max(round) AS last_round, sum(total_rows)::INT AS season_rows FROM land_totals
  WHERE endpoint = 'pit_stops' GROUP BY season) USING (season)
WHERE endpoint = 'pit_stops' GROUP BY ALL"""),
    "land_stream_new_checkpoint": (stream_new_checkpoint, f"""
SELECT season, n AS pages, CASE WHEN season % 2 = 1 THEN n ELSE 0 END AS first, CASE WHEN season % 2 = 0 THEN n ELSE 0 END AS second
FROM {_RESULT_PAGES}"""),
    "land_stream_after_load": (stream_after_load, f"""
SELECT season, n AS pages, CASE WHEN season % 2 = 0 AND n > 1 THEN n ELSE 0 END AS stream,
       CASE WHEN season % 2 = 1 AND n > 1 THEN n ELSE 0 END AS hand, CASE WHEN n = 1 THEN 1 ELSE 0 END::BIGINT AS late
FROM {_RESULT_PAGES}"""),
    "land_stream": (stream, f"""
SELECT season, n AS pages, last_round, total_rows
FROM {_RESULT_PAGES} JOIN (FROM land_marks WHERE endpoint = 'results') USING (season)"""),
}

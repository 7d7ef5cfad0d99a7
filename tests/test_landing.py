import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from apexlake.sources import landing, planning, staging
from apexlake.sources.landing import RawTable
from apexlake.sources.planning import LoadState
from apexlake.sources.runs import land
from apexlake.sources.schemas import LOAD_STATE, TEAM_COLOURS
from apexlake.sources.seed import keep_odd_lines, packaged_team_colours, read_team_colours, seed_lines, team_colour_rows
from apexlake.streaming.landing import incoming_schema, land_new_files
from apexlake.testbed.build import warehouse
from apexlake.testbed.paging import pages

from conftest import rows

NO_LATEST = "season int, latest_round int"


def payload(total, *rounds):
    return json.dumps({"MRData": {"total": str(total), "RaceTable": {"Races": [{"round": str(r)} for r in rounds]}}})


def season_pages(spark, *pages):
    """(season, offset, total, payload)"""
    return spark.createDataFrame(
        [(s, o, 100, t, f"u{o}", p) for s, o, t, p in pages],
        "season int, page_offset int, page_limit int, total_rows int, request_url string, payload string")


def race_pages(spark, *pages):
    """(season, round, offset, total)"""
    return spark.createDataFrame(
        [(s, r, o, 100, t, "u", payload(t, r)) for s, r, o, t in pages],
        "season int, round int, page_offset int, page_limit int, total_rows int, request_url string, payload string")


def latest(spark, *values):
    return spark.createDataFrame(list(values), NO_LATEST)


def state_of(spark, *marks):
    return spark.createDataFrame([(*m, None) for m in marks], LOAD_STATE)


@pytest.mark.parametrize("total, offset, expected", [(367, 0, 100), (367, 300, 67), (367, 400, 0), (0, 0, 0)])
def test_rows_on_a_page(spark, total, offset, expected):
    row = spark.createDataFrame([(100, total, offset)], "l int, t int, o int").select(
        landing.rows_on_page(F.col("l"), F.col("t"), F.col("o")).alias("n")).first()
    assert row.n == expected


def test_readers_take_few_landed_pages_at_once(spark, tmp_path):
    """A reader holds up to 4,096 rows of one row group: pages of 50 KB land in groups of some MB."""
    import pyarrow.parquet as pq

    many = spark.range(0, 1500, 1, 2).select(
        F.lit(2020).alias("season"), (F.col("id") * 100).cast("int").alias("page_offset"), F.lit(100).alias("page_limit"),
        F.lit(150_000).alias("total_rows"), F.lit("u").alias("request_url"),
        F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(800)), lambda k: F.sha2(F.concat_ws("-", k, "id"), 256))).alias("payload"))
    table = RawTable(spark, str(tmp_path))
    table.replace(many, many, "load")
    assert table.read().agg(F.count("*"), F.sum(F.length("payload"))).first()[0] == 1500
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "pages").rglob("*.parquet")]
    groups = [f.row_group(k).total_byte_size for f in files for k in range(f.num_row_groups)]
    assert sum(f.num_rows for f in files) == 1500 and max(groups) < 16 << 20


def test_page_plan(spark):
    scopes = spark.createDataFrame([(2022, 367), (1993, 0)], "season int, total_rows int")
    assert [r.page_offset for r in landing.page_plan(scopes).orderBy("page_offset").collect()] == [0, 100, 200, 300]
    assert landing.page_plan(scopes, limit=1000).count() == 4


def test_highest_round(spark):
    texts = [payload(2, 3, 11), json.dumps({"MRData": {"total": "1", "DriverTable": {"Drivers": []}}}), payload(0), "junk"]
    frame = spark.createDataFrame([(t,) for t in texts], "payload string")
    assert [r.x for r in frame.select(landing.highest_round(F.col("payload")).alias("x")).collect()] == [11, None, None, None]


def test_replacing_a_season_leaves_the_others_and_hides_stale_pages(spark, tmp_path):
    dirty = json.dumps({"MRData": {"total": "1", "note": "quote \" backslash \\ ünï"}})
    table = RawTable(spark, str(tmp_path / "raw"))
    assert table.read().isEmpty()
    first = season_pages(spark, (2023, 0, 150, "a"), (2023, 100, 150, "b"), (2024, 0, 1, dirty))
    table.replace(first, first, "one")
    assert rows(table.read().select("season", "page_offset")) == {(2023, 0), (2023, 100), (2024, 0)}
    assert table.read().where("season = 2024").first().payload == dirty
    assert table.read().select("ingested_at").distinct().count() == 1

    table.replace(season_pages(spark, (2023, 0, 50, "c")), spark.createDataFrame([(2023,)], "season int"), "two")
    assert rows(table.read().select("season", "payload")) == {(2023, "c"), (2024, dirty)}

    none = first.limit(0)
    table.replace(none, spark.createDataFrame([(2023,)], "season int"), "three")
    assert rows(table.read().select("season")) == {(2024,)}


def test_repeating_a_load_does_not_duplicate(spark, tmp_path):
    table = RawTable(spark, str(tmp_path / "raw"))
    first = season_pages(spark, (2023, 0, 1, "a"))
    for _ in range(2):
        table.replace(first, first, "same")
    assert table.read().count() == 1


def test_replacing_a_race_leaves_the_other_rounds(spark, tmp_path):
    table = RawTable(spark, str(tmp_path / "raw"), per_race=True)
    first = race_pages(spark, (2024, 1, 0, 10), (2024, 2, 0, 20))
    table.replace(first, first, "one")
    again = race_pages(spark, (2024, 2, 0, 150), (2024, 2, 100, 150))
    table.replace(again, again, "two")
    assert rows(table.read().select("round", "page_offset", "total_rows")) == {(1, 0, 10), (2, 0, 150), (2, 100, 150)}


@pytest.mark.parametrize("mark, newest, force, due", [
    (None, None, False, True),
    (("results", 2024, 22, 367), None, False, False),
    (("results", 2024, 22, 367), None, True, True),
    (("results", 2024, 12, 240), 14, False, True),
    (("results", 2024, 14, 280), 14, False, False),
    (("results", 2024, None, 0), 14, False, True),
])
def test_skip_or_load(spark, mark, newest, force, due):
    covered = spark.createDataFrame([(2024, "results", False)], "season int, endpoint string, per_race boolean")
    state = state_of(spark, *([mark] if mark else []))
    plan = planning.load_plan(covered, state, latest(spark, *([(2024, newest)] if newest else [])), force)
    assert plan.count() == int(due)


def test_coverage_by_first_season(spark):
    seasons = spark.createDataFrame([(1950,), (2026,)], "season int")
    covered = planning.coverage(seasons, planning.registry(spark))
    assert rows(covered.where("season = 1950").select("endpoint")) == {
        ("races",), ("results",), ("drivers",), ("driver_standings",)}
    assert covered.where("season = 2026").count() == 9


def test_season_spine(spark):
    assert [r.season for r in planning.season_spine(spark, 2020, 2023).collect()] == [2020, 2021, 2022, 2023]
    assert planning.season_spine(spark, None, 1952).count() == 3
    with pytest.raises(ValueError):
        planning.season_spine(spark, 2023, 2020)


def test_resume_after_progress(spark):
    calendar = spark.createDataFrame([(2024, r) for r in range(1, 12)], "season int, round int")
    plan = lambda *marks, **kw: sorted(
        r.round for r in planning.resume_plan(calendar, state_of(spark, *marks), latest(spark), "laps", **kw).collect())
    assert plan(("laps_progress", 2024, 7, 7300)) == [8, 9, 10, 11]
    assert plan(("laps_progress", 2024, 7, 7300), force=True) == list(range(1, 12))
    assert plan() == list(range(1, 12))
    capped = planning.resume_plan(calendar, state_of(spark, ("laps", 2024, 2, 9)), latest(spark, (2024, 4)), "laps")
    assert rows(capped) == {(2024, 3), (2024, 4)}


def test_newest_round_of_a_running_season_is_retried(spark, tmp_path):
    table, state = RawTable(spark, str(tmp_path / "r"), per_race=True), LoadState(spark, str(tmp_path / "s"))
    state.create()
    pages = race_pages(spark, (2026, 13, 0, 90))
    wanted = spark.createDataFrame([(2026, 13), (2026, 14)], "season int, round int")
    land("laps", table, state, pages, wanted, latest(spark, (2026, 14)), "one")
    marks = rows(state.read().select("endpoint", "last_round", "total_rows"))
    assert marks == {("laps_progress", 13, 90)}
    # Published a day later: the total counts what had landed before.
    later = race_pages(spark, (2026, 14, 0, 80))
    land("laps", table, state, later, later, latest(spark, (2026, 14)), "two")
    marks = rows(state.read().select("endpoint", "last_round", "total_rows"))
    assert marks == {("laps_progress", 14, 170), ("laps", 14, 170)}


def test_an_unpublished_round_keeps_what_is_landed(spark, tmp_path):
    table, state = RawTable(spark, str(tmp_path / "r"), per_race=True), LoadState(spark, str(tmp_path / "s"))
    state.create()
    both = race_pages(spark, (2026, 1, 0, 50), (2026, 2, 0, 60))
    land("laps", table, state, both, both, latest(spark, (2026, 2)), "one")
    forced = race_pages(spark, (2026, 1, 0, 55))
    wanted = spark.createDataFrame([(2026, 1), (2026, 2)], "season int, round int")
    land("laps", table, state, forced, wanted, latest(spark, (2026, 2)), "two")
    assert rows(table.read().select("round", "total_rows")) == {(1, 55), (2, 60)}
    assert ("laps_progress", 1, 55) in rows(state.read().select("endpoint", "last_round", "total_rows"))


def test_a_broken_race_stops_progress_before_it(spark, tmp_path):
    table, state = RawTable(spark, str(tmp_path / "r"), per_race=True), LoadState(spark, str(tmp_path / "s"))
    state.create()
    pages = race_pages(spark, (2010, 1, 0, 50), (2010, 2, 0, 150), (2010, 3, 0, 70))
    _, failures = land("laps", table, state, pages, pages, latest(spark), "one")
    assert rows(failures) == {(2010, "laps", "missing page")}
    assert rows(state.read().select("endpoint", "last_round", "total_rows")) == {("laps_progress", 1, 50)}
    assert rows(table.read().select("round")) == {(1,), (3,)}


def test_an_empty_past_race_is_absence(spark, tmp_path):
    table, state = RawTable(spark, str(tmp_path / "r"), per_race=True), LoadState(spark, str(tmp_path / "s"))
    state.create()
    pages = race_pages(spark, (1996, 1, 0, 90))
    wanted = spark.createDataFrame([(1996, 1), (1996, 2)], "season int, round int")
    land("laps", table, state, pages, wanted, latest(spark), "one")
    assert ("laps", 2, 90) in rows(state.read().select("endpoint", "last_round", "total_rows"))


def test_season_watermarks(spark):
    pages = season_pages(spark, (2024, 0, 367, payload(367, 1, 5)), (2024, 100, 367, payload(367, 5, 22)))
    seasons = spark.createDataFrame([(2024,), (1993,)], "season int")
    plain = planning.season_watermarks("results", seasons, pages, latest(spark))
    assert rows(plain) == {("results", 2024, 22, 367), ("results", 1993, None, 0)}
    current = planning.season_watermarks("drivers", seasons, pages, latest(spark, (2024, 9)))
    assert ("drivers", 2024, 9, 367) in rows(current)


def test_one_bad_season_does_not_sink_the_run(spark, tmp_path):
    table, state = RawTable(spark, str(tmp_path / "r")), LoadState(spark, str(tmp_path / "s"))
    state.create()
    old = season_pages(spark, (2023, 0, 1, payload(1, 1)))
    land("results", table, state, old, old, latest(spark), "old")
    fresh = season_pages(spark, (2023, 0, 2, "{not json"), (2024, 0, 1, payload(1, 3)), (2025, 0, 150, payload(150, 1)))
    _, failures = land("results", table, state, fresh, fresh, latest(spark), "new")
    assert rows(failures) == {(2023, "results", "unreadable page"), (2025, "results", "missing page")}
    assert rows(table.read().select("season", "payload")) == {(2023, payload(1, 1)), (2024, payload(1, 3))}
    assert rows(state.read().select("season", "last_round")) == {(2023, 1), (2024, 3)}


def test_state_is_missing_only_where_allowed(spark, tmp_path):
    state = LoadState(spark, str(tmp_path / "none"))
    assert state.read(missing_ok=True).isEmpty()
    with pytest.raises(FileNotFoundError):
        state.read()


def test_state_upsert_replaces_one_row(spark, tmp_path):
    state = LoadState(spark, str(tmp_path / "s"))
    schema = "endpoint string, season int, last_round int, total_rows int"
    state.upsert(spark.createDataFrame([("results", 2024, 22, 367), ("drivers", 2024, None, 25)], schema))
    state.upsert(spark.createDataFrame([("results", 2024, 25, 500)], schema))
    assert rows(state.read().select("endpoint", "last_round", "total_rows")) == {("results", 25, 500), ("drivers", None, 25)}


def test_run_summary(spark):
    loaded = spark.createDataFrame([("results", 2024, 22, 367)], "endpoint string, season int, last_round int, total_rows int")
    failed = spark.createDataFrame([(2023, "laps", "missing page")], "season int, endpoint string, reason string")
    row = planning.run_summary(loaded, failed).first()
    assert (row.loaded, row.source_rows, row.endpoint_seasons, row.failures) == (
        1, 367, ["2024 results"], ["2023 laps: missing page"])
    quiet = planning.run_summary(loaded.limit(0), failed.limit(0)).first()
    assert (quiet.loaded, quiet.source_rows, quiet.failures) == (0, 0, [])


def test_seed(spark, tmp_path):
    assert len(team_colour_rows()) == packaged_team_colours(spark).count() == 49
    path = tmp_path / "colours.csv"
    path.write_text("constructor_id,team_colour,text_colour\nferrari,#E8002D,#FFFFFF\n", "utf-8")
    assert rows(read_team_colours(spark, str(path))) == {("ferrari", "#E8002D", "#FFFFFF")}
    path.write_text("constructor_id,team_colour,text_colour\na,#000001,#FFFFFF\nb,#000002\nc,#000003,#FFFFFF,more\nd,,#FFFFFF\n", "utf-8")
    good, odd = seed_lines(spark, str(path), TEAM_COLOURS)
    assert rows(good) == {("a", "#000001", "#FFFFFF")}
    assert rows(odd) == {("b,#000002",), ("c,#000003,#FFFFFF,more",), ("d,,#FFFFFF",)}
    for kept in (1, 2):
        assert keep_odd_lines(odd, str(tmp_path / "odd")).count() == 3 * kept


def test_stream_lands_each_file_once(spark, tmp_path):
    table, state = RawTable(spark, str(tmp_path / "r")), LoadState(spark, str(tmp_path / "s"))
    state.create()
    incoming = tmp_path / "in"

    def deliver(*pages):
        season_pages(spark, *pages).write.mode("append").json(str(incoming))

    def run():
        land_new_files(spark, "results", str(incoming), table, state, latest(spark), str(tmp_path / "c")).awaitTermination()

    deliver((2023, 0, 1, payload(1, 1)))
    run(), run()
    assert rows(table.read().select("season", "payload")) == {(2023, payload(1, 1))}
    deliver((2023, 0, 2, payload(2, 2)), (2024, 0, 1, payload(1, 1)))
    run()
    assert rows(table.read().select("season", "total_rows")) == {(2023, 2), (2024, 1)}
    assert rows(state.read().select("season", "last_round", "total_rows")) == {(2023, 2, 2), (2024, 1, 1)}
    assert "ingested_at" not in incoming_schema(table).names


def test_freshness(spark):
    from apexlake.plans.checks import freshness

    pages = spark.createDataFrame([(dt.datetime(2026, 9, 1),)], "ingested_at timestamp")
    status = lambda day: freshness(pages, F.lit(day).cast("timestamp")).first().status
    assert [status("2026-09-05"), status("2026-09-20"), status("2026-11-01")] == ["pass", "warn", "error"]
    assert freshness(pages.limit(0), F.lit("2026-09-05").cast("timestamp")).first().status == "error"


def test_an_empty_round_before_a_failed_newest_one_is_absence(spark):
    planned = spark.createDataFrame([(2026, 1), (2026, 2)], "season int, round int")
    outcomes = planning.round_outcomes(planned, race_pages(spark, (2026, 1, 0, 10)), latest(spark, (2026, 3)))
    assert rows(outcomes.select("round", "outcome")) == {(1, "landed"), (2, "absent")}


def test_a_repeat_under_the_same_id_hides_old_pages(spark, tmp_path):
    table = RawTable(spark, str(tmp_path / "r"))
    pages = season_pages(spark, (1990, 0, 1, payload(1, 1)), (1991, 0, 1, payload(1, 1)))
    table.replace(pages, pages, "day1")
    table.replace(pages.where("season = 1990"), pages, "day1")
    assert rows(table.read().select("season")) == {(1990,)}
    table.remove_superseded()
    assert rows(table.read().select("season")) == {(1990,)}
    assert len(list((tmp_path / "r" / "pages").glob("load_id=*"))) == 1


def test_state_takes_writers_side_by_side(spark, tmp_path):
    state = LoadState(spark, str(tmp_path / "s"))
    state.create()
    schema = "endpoint string, season int, last_round int, total_rows int"
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(lambda k: state.upsert(spark.createDataFrame([(f"e{k}", 2024, k, k)], schema)), range(9)))
    assert state.read().count() == 9
    state.compact()
    assert state.read().count() == 9 and len(list((tmp_path / "s").glob("write=*"))) == 1


def test_failures_and_rejects_are_kept(spark, tmp_path):
    table, state = RawTable(spark, str(tmp_path / "r")), LoadState(spark, str(tmp_path / "s"))
    state.create()
    pages = season_pages(spark, (2023, 0, 2, "{not json"), (2024, 0, 1, payload(1, 3)))
    land("results", table, state, pages, pages, latest(spark), "one")
    assert rows(table.failures().select("season", "reason", "load_id")) == {(2023, "unreadable page", "one")}
    assert rows(table.rejects().select("season", "payload")) == {(2023, "{not json")}


def test_a_scope_split_over_two_stream_runs_lands(spark, tmp_path):
    table, state = RawTable(spark, str(tmp_path / "r")), LoadState(spark, str(tmp_path / "s"))
    state.create()
    pages = season_pages(spark, *[(2020, offset, 250, payload(250, 7)) for offset in (0, 100, 200)])
    pages = pages.select(*[f.name for f in incoming_schema(table)])
    for part in ("page_offset < 200", "page_offset = 200"):
        pages.where(part).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        land_new_files(spark, "results", str(tmp_path / "in"), table, state, latest(spark), str(tmp_path / "c")).awaitTermination()
    assert table.read().count() == 3
    assert rows(state.read().select("season", "total_rows")) == {(2020, 250)}
    assert rows(table.failures().select("reason")) == {("missing page",)}


class Landing:
    """A table with its state, fed by streams and by hand."""

    def __init__(self, spark, folder, per_race=False):
        self.spark, self.folder = spark, folder
        self.endpoint = "pit_stops" if per_race else "results"
        self.table, self.state = RawTable(spark, str(folder / "r"), per_race), LoadState(spark, str(folder / "s"))
        self.state.create()

    def pages(self, text, *offsets, season=1990, total=250):
        made = season_pages(self.spark, *[(season, offset, total, payload(total, 7, text)) for offset in offsets])
        return made.select(*[f.name for f in incoming_schema(self.table)])

    def deliver(self, pages, stream="a"):
        pages.coalesce(1).write.mode("append").json(str(self.folder / f"in-{stream}"))
        self.run(stream)

    def run(self, stream="a", checkpoint=None):
        land_new_files(
            self.spark, self.endpoint, str(self.folder / f"in-{stream}"), self.table, self.state, latest(self.spark),
            str(self.folder / (checkpoint or f"c-{stream}"))).awaitTermination()

    def shown(self):
        return rows(self.table.read().select("page_offset", F.regexp_extract("payload", "(old|new|hand)", 1)))

    def waiting(self):
        return sorted(str(p.relative_to(self.folder / "r" / "waiting").parent) for p in (self.folder / "r").glob("waiting/**/*.parquet"))


def test_a_new_checkpoint_lands_its_pages(spark, tmp_path):
    at = Landing(spark, tmp_path)
    at.deliver(at.pages("old", 0, 100, 200), "a")
    at.deliver(at.pages("new", 0, 100, 200), "b")  # its batch 0 too
    assert at.shown() == {(0, "new"), (100, "new"), (200, "new")}
    at.run("a", "c-third")  # a third checkpoint reads the first stream's files once more
    assert at.shown() == {(0, "old"), (100, "old"), (200, "old")}
    assert at.waiting() == []


def test_a_scope_spread_over_two_streams_lands(spark, tmp_path):
    at = Landing(spark, tmp_path)
    at.deliver(at.pages("old", 0, 100), "a")
    assert at.shown() == set() and len(at.waiting()) == 1
    at.deliver(at.pages("new", 100, 200), "b")
    assert at.shown() == {(0, "old"), (100, "new"), (200, "new")}
    assert at.waiting() == []


def test_part_of_a_scope_after_a_load_by_hand_changes_nothing(spark, tmp_path):
    at = Landing(spark, tmp_path)
    at.deliver(at.pages("old", 0, 100, 200))
    at.deliver(at.pages("old", 100))
    by_hand = at.pages("hand", 0, 100, 200)
    land("results", at.table, at.state, by_hand, by_hand, latest(spark), "hand")
    assert at.waiting() == []  # what waited is used up
    at.deliver(at.pages("new", 0))
    assert at.shown() == {(0, "hand"), (100, "hand"), (200, "hand")}
    at.deliver(at.pages("new", 100, 200))
    assert at.shown() == {(0, "new"), (100, "new"), (200, "new")}


def test_a_batch_reads_only_the_scopes_it_touches(spark, tmp_path):
    at = Landing(spark, tmp_path)
    at.deliver(at.pages("old", 0))
    for season in (1991, 1992):
        at.deliver(at.pages("old", 0, season=season))
    area = at.table.waiting
    area.in_scopes([(1991,)]).select("payload").count()
    assert all("season=1991" in name for name in area.in_scopes([(1991,)]).inputFiles())
    again = area.begin("other", 0)
    opened = at.table.arrive(_arrived(at.pages("new", 100, season=1992)), again)
    assert rows(opened.select("season", "page_offset")) == {(1992, 0), (1992, 100)}
    assert all("season=1992" in name for name in opened.inputFiles() if "/waiting/" in name)


def _arrived(pages):
    return pages.withColumn("file_time", F.lit(None).cast("timestamp")).withColumn("file_name", F.lit("f"))


@pytest.mark.parametrize("broken", ["upsert", "settle", "remove_used"])
def test_a_repeated_batch_finishes_what_broke_off(spark, tmp_path, monkeypatch, broken):
    """A batch fails at any step of its landing and is replayed: pages and watermark are there once."""
    from apexlake.sources.waiting import WaitingArea

    at = Landing(spark, tmp_path)
    at.deliver(at.pages("old", 0, 100))

    def fail(*_):
        raise RuntimeError("lost")

    where = {"upsert": (LoadState, "upsert"), "settle": (WaitingArea, "settle"), "remove_used": (WaitingArea, "remove_used")}
    with monkeypatch.context() as patched:
        patched.setattr(*where[broken], fail)
        with pytest.raises(Exception, match="lost"):
            at.deliver(at.pages("new", 200))
    at.run()
    assert sorted(tuple(r) for r in at.table.read().select("page_offset").collect()) == [(0,), (100,), (200,)]
    assert rows(at.state.read().select("season", "total_rows")) == {(1990, 250)}
    at.deliver(at.pages("old", 0))
    assert at.shown() == {(0, "old"), (100, "old"), (200, "new")} and len(at.waiting()) == 1


def test_one_place_twice_in_a_delivery_lands_once(spark, tmp_path):
    at = Landing(spark, tmp_path)
    at.deliver(at.pages("old", 0, 0, 100, 200).unionByName(at.pages("old", 100)))
    assert at.table.read().count() == 3


def test_lines_that_are_no_page_are_rejected(spark, tmp_path):
    at = Landing(spark, tmp_path)
    (tmp_path / "in-a").mkdir()
    (tmp_path / "in-a" / "odd.json").write_text('not json at all\n{"season": null, "page_offset": 0, "payload": "x"}\n')
    at.run()
    assert rows(at.table.rejects().select("season", "payload")) == {(None, "not json at all"), (None, "x")}
    assert at.table.read().count() == 0 and at.waiting() == []


def test_the_delivery_log_is_folded(spark, tmp_path, monkeypatch):
    from apexlake.sources import waiting

    monkeypatch.setattr(waiting, "FOLD_AFTER", 4)
    area = Landing(spark, tmp_path).table.waiting
    numbers = []
    for batch in range(4):
        for source in ("a", "b"):
            delivery = area.begin(source, batch)
            numbers.append(delivery.number)
            area.settle(delivery)
    assert numbers == sorted(set(numbers))
    assert len(list((tmp_path / "r" / "deliveries").glob("write=*"))) <= 5
    assert area.begin("a", 3).landed and area.begin("a", 3).number == numbers[-2]
    assert area.begin("c", 0).number == numbers[-1] + 1


def orders_at(spark, folder):
    """Two drivers of one team in two races; the first has two cars with lines in the first race, one of them entered twice."""
    day = dt.datetime
    at = [(1, 10, day(1999, 1, 5)), (2, 10, day(1999, 1, 6)), (2, 10, day(1999, 1, 6)), (3, 11, day(1999, 1, 7)), (4, 11, day(1999, 2, 7))]
    spark.createDataFrame(
        [(k, c, "F", 100.0 + k, when, "5-LOW") for k, c, when in at],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
    ).write.parquet(f"{folder}/orders.parquet")
    lines = [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (9, 1), (None, 1)]
    spark.createDataFrame(
        [(k, 7, 8, n, 50.0 + n, 3.0, "R" if n == 2 else "N") for k, n in lines],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_quantity double, l_returnflag string",
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(n, f"N{n}", 0) for n in range(25)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(
        f"{folder}/nation.parquet")
    spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string").write.parquet(f"{folder}/region.parquet")
    return str(folder)


def test_only_endpoints_that_are_read_are_landed(spark, tmp_path):
    """Once every query landed the pages of all nine endpoints before it began."""
    lake = warehouse(spark, orders_at(spark, tmp_path))
    assert lake.table("stg_races").count() == 12
    assert [e for e in lake.raw if e in lake.raw._known] == ["races"]
    assert set(lake.raw) == set(staging.MODELS) == set(lake.logs)


def test_laps_go_on_over_the_cars_of_a_driver(spark, tmp_path):
    lake = warehouse(spark, orders_at(spark, tmp_path))
    laps = lake.table("stg_laps").groupBy("round", "driver_id").agg(F.sort_array(F.collect_list("lap")))
    assert rows(laps.withColumn("laps", F.array_join(laps[2], " ")).select("round", "driver_id", "laps")) == {(1, "d10", "1 2 3 4 5 6"), (1, "d11", "1")}
    done = lake.table("stg_results").select("round", "car_number", "laps_completed")
    assert rows(done) == {(1, 1, 2), (1, 2, 6), (1, 3, 1), (2, 4, 0)}


def test_rows_of_pages_move_once(spark, tmp_path):
    """From numbered rows to the landed files there is one shuffle; a page's lists were once brought together one by one."""
    items = spark.createDataFrame(
        [(2024, 1, n % 3 + 1, n // 3 + 1, (str(n),)) for n in range(450)],
        "season int, round int, lap long, place long, item struct<driverId:string>")
    landed = pages(items, "laps")
    plan = landed._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    table = RawTable(spark, str(tmp_path / "laps"), per_race=True)
    table.replace(landed, landed, "one", together=True)
    assert [row["page_offset"] for row in table.read().orderBy("page_offset").collect()] == [0, 100, 200, 300, 400]
    laps = staging.laps(table.read())
    assert rows(laps.groupBy("lap").agg(F.count("*"), F.count_distinct("driver_id"))) == {(1, 150, 150), (2, 150, 150), (3, 150, 150)}


def test_items_are_made_where_pages_are_packed(spark):
    """Rows move as what their items are made of; whole items, several times as large, once moved with them."""
    cars = spark.createDataFrame(
        [(2024, 1, n % 3 + 1, n // 3 + 1, n) for n in range(450)], "season int, round int, lap long, place long, ckey long")
    item = F.struct(F.concat(F.lit("d"), F.col("ckey")).alias("driverId"))
    landed = pages(cars, "laps", item=item)
    plan = landed._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    above, below = plan.split("Exchange hashpartitioning")
    assert "driverId" in above and "driverId" not in below
    ready = pages(cars.select("season", "round", "lap", "place", item.alias("item")), "laps")
    columns = ["season", "round", "page_offset", "total_rows", "payload"]
    assert rows(landed.select(*columns)) == rows(ready.select(*columns))
    assert landed.count() == 5

"""The physical plans keep the properties that matter on large data."""

import re
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from apexlake.operators import joins
from apexlake.plans import report
from apexlake.plans.assertions import ASSERTIONS
from apexlake.plans.warehouse import MODELS, RACE_FACTS
from apexlake.session import shared_folder
from apexlake.testbed.build import warehouse


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark):
    lake = warehouse(spark, "/root/testdata/sf0.001")
    for name in MODELS:
        lake.table(name)
    return lake


@pytest.fixture
def shuffled(spark, monkeypatch):
    """No broadcasts, so every join shows the shuffle it needs."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", re.sub(r"#\d+L?", "", plan))


@pytest.mark.parametrize("name", [n for n in MODELS if n.startswith("stg_")])
def test_a_page_is_parsed_once(lake, name):
    assert physical(lake.model(name)).count("from_json") == 1


@pytest.mark.parametrize("name", [n for n in MODELS if not n.startswith("stg_")])
def test_no_cartesian_products_and_no_python(lake, shuffled, name):
    plan = physical(lake.model(name))
    assert "CartesianProduct" not in plan and "Python" not in plan and "MapInPandas" not in plan
    # The newest season is one row.
    assert plan.count("NestedLoopJoin") == (1 if name == "dim_season" else 0)


def test_sprints_and_races_are_brought_together_in_one_shuffle(lake):
    found = exchanges(physical(lake.model("int_driver_form")))
    assert [e.rsplit(", ", 1)[0] for e in found] == ["driver_id", "season, round, driver_id"]


def test_season_statistics_take_one_shuffle(lake):
    found = exchanges(physical(lake.model("fct_driver_standings")))
    assert [e.rsplit(", ", 1)[0] for e in found] == ["season, driver_id"]


def test_runs_need_no_shuffle_beyond_the_career(lake):
    from apexlake.operators.sequences import islands

    runs = islands(lake.table("int_driver_race"), "driver_id", ["race_date", "race_id"], {"win": "won"}, ["race_id"])
    lengths = runs.groupBy("driver_id", "run_type", "run").agg(F.count("*"))
    assert [e.rsplit(", ", 1)[0] for e in exchanges(physical(lengths))] == ["driver_id"]


def test_pairs_take_one_shuffle_and_no_join(lake):
    plan = physical(lake.model("int_teammate_qualifying"))
    assert len(exchanges(plan)) == 1 and "Join" not in plan


def test_windows_never_run_over_a_race_or_a_season_of_rows(lake):
    """Windows by race or season see counted values only, cut to the best before they are shuffled."""
    for query in (report.season_leaders, report.leader_margin, report.leading_drivers):
        plan = physical(query(lake.table))
        assert plan.count("WindowGroupLimit") == 2, query.__name__
    # A cell of names takes as many as it may hold, and one more to tell that there are too many.
    assert physical(report.championship_leader(lake.table)).count("WindowGroupLimit") == 4


def test_a_cell_of_too_many_names_ends_the_job(spark, monkeypatch):
    monkeypatch.setattr(report, "NAMES_IN_A_CELL", 2)
    holders = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, "c")], "g int, who string")
    few = report.joined_names(holders.where("who IS NOT NULL"), ["g"], "who", "holder")
    assert {tuple(r) for r in few.collect()} == {(1, "a, b"), (2, "c")}
    with pytest.raises(Exception, match="more than 2 names"):
        report.joined_names(holders, ["g"], "who", "holder").collect()


def test_model_windows_run_over_a_career(lake):
    for name in MODELS:
        for keys in re.findall(r"windowspecdefinition\((.*?), [a-z_]+ (?:ASC|DESC)", re.sub(r"#\d+L?", "", physical(lake.model(name)))):
            assert keys in ("driver_id", "streak_type"), (name, keys)


def test_scans_read_only_the_columns_used(lake):
    plan = physical(report.total_points(lake.table))
    assert re.search(r"ReadSchema: struct<race_id:int,driver_id:string,total_points:double>", plan)


def test_a_season_reads_only_its_partition(lake):
    plan = physical(lake.table("stg_laps").where("season = 1999 AND lap = 3"))
    assert re.search(r"PartitionFilters: \[isnotnull\(season#\d+\), \(season#\d+ = 1999\)\]", plan)
    assert "PushedFilters: [IsNotNull(lap), EqualTo(lap,3)]" in plan


def test_assertions_have_no_cartesian_products(lake, shuffled):
    for name, (check, _) in ASSERTIONS.items():
        plan = physical(check(lake.table))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_declared_checks_scan_little(lake):
    """Nulls and unaccepted values were counted on writing; foreign keys take one scan a table and one shuffle."""
    from apexlake.plans import checks
    from apexlake.plans.quality import DECLARED

    none = checks.Declared({}, [], {}, [], [])
    counted = checks.report(lake.table, replace(none, not_null={t: c for t, c in DECLARED.not_null.items() if t != "team_colours"}), lake.figures)
    assert "FileScan" not in physical(counted)
    accepted = [a for a in DECLARED.accepted if a[0] != "team_colours"]
    assert "FileScan" not in physical(checks.report(lake.table, replace(none, accepted=accepted), lake.figures))
    plan = physical(checks.orphans(lake.table, DECLARED.relationships))
    tables = {t for child, _, parent in DECLARED.relationships for t in (child, parent)} - {"team_colours"}
    assert plan.count("FileScan") == len(tables)
    assert [e.rsplit(", ", 1)[0] for e in exchanges(plan)] == ["parent", "parent, key"]


def test_a_page_of_one_race_reads_one_season(lake):
    season, races = 1999, lake.table("dim_race").where("has_results").groupBy().agg(F.max("race_id").alias("race_id"))
    last = races.first().race_id
    for name in RACE_FACTS:
        one = lake.chosen(race_id=season * 100 + 3)(name)
        assert one.columns == lake.table(name).columns
        for pruned, year in ((one, 1999), (lake.chosen(season=season)(name), 1999), (lake.chosen(races=races)(name), last // 100)):
            assert re.search(rf"PartitionFilters: \[[^\]]*season#\d+ = {year}\)", physical(pruned)), physical(pruned)
        assert one.isEmpty() or "season=1999" in one.select(F.input_file_name()).first()[0]
        expected = lake.table(name).where(F.col("race_id") == season * 100 + 3)
        assert one.exceptAll(expected).isEmpty() and expected.exceptAll(one).isEmpty()
    assert lake.chosen(season=season)("dim_driver") is lake.table("dim_driver")
    assert {r.season for r in lake.chosen(season=season)("fct_driver_standings").select("season").collect()} == {season}


def test_records_take_one_scan_and_ranks_write_nothing(lake):
    plan = physical(report.record_holders(lake.table))
    assert plan.count("FileScan") == 2 and plan.count("WindowGroupLimit") == 2  # careers and names
    before = set(Path(shared_folder(lake.colours.sparkSession), "written").iterdir())
    report.finish_rank(lake.table).count()
    assert set(Path(shared_folder(lake.colours.sparkSession), "written").iterdir()) == before


def test_freshness_reads_the_log_only(lake):
    from apexlake.plans.checks import freshness

    for log in lake.logs.values():
        read = freshness(log, F.current_timestamp())
        assert all("/loads/" in f for f in read.inputFiles())

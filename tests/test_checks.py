import re

import pytest
from pyspark.sql import functions as F

from apexlake.plans import checks
from apexlake.plans.assertions import colours_are_hex, durations_read_back, last_lap_matches
from apexlake.plans.warehouse import COLUMN_DESCRIPTIONS, DESCRIPTIONS, MARTS, MODELS, catalogued, described
from apexlake.sources.seed import packaged_team_colours

from conftest import rows


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(
        [(1, "a", "win"), (1, "a", "podium"), (2, "b", "draw"), (None, "ghost", None), (3, None, "win")],
        "race int, driver string, kind string")


def test_not_null_returns_the_rows(facts):
    assert rows(checks.not_null(facts, "race", "driver")) == {(None, "ghost", None), (3, None, "win")}


def test_nulls_of_a_table_are_found_in_one_pass(facts):
    declared = checks.Declared({"facts": {"race": "error", "driver": "warn", "kind": "error"}}, [], {}, [], [])
    counted = checks.report(lambda name: facts, declared)
    assert rows(counted.select("target", "severity", "violations")) == {
        ("race", "error", 1), ("driver", "warn", 1), ("kind", "error", 1)}
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Filter") == 1


def test_last_laps_do_not_bring_the_drivers_of_a_race_together(spark):
    tables = {
        "raw_laps": spark.createDataFrame([(2000, 1), (2000, 2), (2000, 3), (2000, None)], "season int, round int"),
        "fct_lap_positions": spark.createDataFrame(
            [(200001, "a", 3), (200001, "b", 2), (200001, None, 1), (200002, "a", 0), (200003, "c", 5), (200004, "a", 1)], "race_id int, driver_id string, lap int"),
        "fct_race_results": spark.createDataFrame(
            [(200001, "a", 3), (200001, "b", 3), (200001, "d", 1), (200001, "e", 0), (200001, None, 1), (200002, "a", 4), (200004, "a", 9)],
            "race_id int, driver_id string, laps_completed int"),
    }
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wrong = last_lap_matches(tables.get)
        found, plan = rows(wrong), wrong._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == {
        (200001, "b", 3, 2), (200001, "d", 1, None), (200001, None, 1, None), (200002, None, None, None), (200003, None, None, None), (None, None, None, None)}
    assert not re.search(r"SortMergeJoin \[race_id#\d+\], \[race_id#\d+\], Left(Outer|Semi)", plan)


def test_unique_and_combinations(facts):
    assert rows(checks.unique(facts, "driver")) == {("a", 2)}
    assert checks.unique(facts, "driver", "kind").isEmpty()


def test_relationships_let_null_pass_and_count_rows(spark, facts):
    drivers = spark.createDataFrame([("b",)], "driver string")
    assert rows(checks.relationships(facts, "driver", drivers, "driver")) == {("a", 2), ("ghost", 1)}


def test_orphans_of_all_keys_in_one_shuffle(spark, facts):
    """Two keys into one parent, one key from two children, numbers and text, null keys and keys without any child."""
    tables = {
        "facts": facts, "more": spark.createDataFrame([(1, "a"), (9, "z"), (9, None)], "race int, driver string"),
        "races": spark.createDataFrame([(1,), (2,), (None,), (7,)], "race int"),
        "drivers": spark.createDataFrame([("b",), ("9",)], "driver string"),
    }
    keys = [("facts", "race", "races"), ("more", "race", "races"), ("facts", "driver", "drivers"), ("more", "driver", "drivers")]
    lost = checks.orphans(tables.__getitem__, keys)
    assert rows(lost) == {
        ("facts", "race in races", 1), ("more", "race in races", 2), ("facts", "driver in drivers", 3), ("more", "driver in drivers", 2)}
    for child, column, parent in keys:
        single = checks.relationships(tables[child], column, tables[parent], column)
        assert single.agg(F.sum("n")).first()[0] == {(t, k): n for t, k, n in lost.collect()}[child, f"{column} in {parent}"]
    assert checks.orphans(tables.__getitem__, [("races", "race", "races")]).isEmpty()


def test_figures_taken_while_writing_spare_the_scan(spark, facts):
    declared = checks.Declared({"facts": {"race": "error", "driver": "warn"}}, [], {}, [], [("facts", "kind", ["win", "podium"])])
    counts = checks.measures("facts", declared)
    figures = facts.agg(*[c.alias(n) for n, c in counts.items()]).first().asDict()
    assert sorted(figures.values()) == [1, 1, 1]
    by_scan, known = checks.report(lambda name: facts, declared), checks.report(lambda name: facts, declared, lambda name: figures)
    assert rows(by_scan) == rows(known) and known.count() == 3
    assert checks.measures("other", declared) == {}


def test_accepted_values_let_null_pass(facts):
    assert rows(checks.accepted_values(facts, "kind", ["win", "podium"])) == {("draw", 1)}


def test_only_errors_fail_a_build(facts):
    declared = checks.Declared(
        {"facts": {"race": "warn", "driver": "error"}}, [("facts", "driver")], {"facts": ("driver", "kind")}, [],
        [("facts", "kind", ["win", "podium", "draw"])])
    report = checks.report(lambda name: facts, declared)
    assert report.columns == checks.REPORT and report.count() == 5
    assert rows(checks.build_fails(report).select("check_name", "target")) == {("not_null", "driver"), ("unique", "driver")}


def test_seed_colours_are_hex(spark):
    assert colours_are_hex(packaged_team_colours(spark)).isEmpty()
    bad = spark.createDataFrame([("x", "#abc123", "#000000")], "constructor_id string, team_colour string, text_colour string")
    assert colours_are_hex(bad).count() == 1


def test_durations_read_back(spark):
    frame = lambda pairs, text, seconds: spark.createDataFrame(pairs, f"{text} string, {seconds} double")
    quali = spark.createDataFrame([("1:29.179", 89.179, None, None, None, None)], ", ".join(
        f"q{n}_time string, q{n}_seconds double" for n in (1, 2, 3)))
    tables = {
        "stg_laps": frame([("1:30.000", 90.0), ("no time", None), ("1:30.000", 91.0)], "lap_time", "lap_time_seconds"),
        "stg_pit_stops": frame([("25.208", 25.208), ("1:02.345", 62.345), ("junk", 0.0)], "duration", "duration_seconds"),
        "stg_qualifying": quali,
    }
    assert rows(durations_read_back(tables.__getitem__)) == {("1:30.000", 91.0, 1), ("junk", 0.0, 1)}


def test_descriptions_travel_with_saved_tables(spark, tmp_path):
    assert set(DESCRIPTIONS) == set(MODELS)
    assert not any("'" in text for text in [*DESCRIPTIONS.values(), *COLUMN_DESCRIPTIONS.values()])
    frame = described(spark.createDataFrame([(202401, "x")], "race_id int, other string"), COLUMN_DESCRIPTIONS)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS saved LOCATION '{tmp_path}/saved.db'")
    frame.write.mode("overwrite").saveAsTable("saved.some_mart")
    comments = {r.col_name: r.comment for r in spark.sql("DESCRIBE saved.some_mart").collect()}
    assert comments == {"race_id": "season * 100 + round", "other": None}
    spark.sql("DROP DATABASE saved CASCADE")


def test_views_and_marts_can_be_published(spark, tmp_path):
    from apexlake.testbed.build import warehouse

    lake = warehouse(spark, "/root/testdata/sf0.001")
    lake.register_views(["stg_races", "dim_race"])
    assert spark.sql("SELECT count(*) AS n FROM dim_race JOIN stg_races USING (season, round)").first().n == 84
    spark.sql(f"CREATE DATABASE IF NOT EXISTS marts LOCATION '{tmp_path}/marts.db'")
    lake.save_marts("marts")
    assert {r.tableName for r in spark.sql("SHOW TABLES IN marts").collect() if not r.isTemporary} == set(MARTS)
    detail = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED marts.dim_race").collect()}
    assert detail["Comment"] == DESCRIPTIONS["dim_race"]
    spark.sql("DROP DATABASE marts CASCADE")


def test_staging_is_published_where_it_lies(spark, tmp_path):
    from apexlake.testbed.build import warehouse

    lake = warehouse(spark, "/root/testdata/sf0.001")
    spark.sql(f"CREATE DATABASE staged LOCATION '{tmp_path}/staged.db'")
    lake.publish("staged", ["stg_laps", "int_driver_race", "fct_qualifying"])
    for name in ("stg_laps", "int_driver_race", "fct_qualifying"):
        assert spark.table(f"staged.{name}").count() == lake.table(name).count()
        assert spark.table(f"staged.{name}").inputFiles()[0].split("file:")[-1].lstrip("/").startswith(lake.paths[name].split("file:")[-1].lstrip("/"))
    listed = {(r, c): (about, text) for r, about, c, text in catalogued(spark, "staged")}
    assert listed["fct_qualifying", "race_id"] == (DESCRIPTIONS["fct_qualifying"], COLUMN_DESCRIPTIONS["race_id"])
    assert listed["stg_laps", "driver_id"] == (DESCRIPTIONS["stg_laps"], None)
    spark.sql("DROP DATABASE staged CASCADE")


def test_rows_are_counted_as_tables_are_written(spark):
    from apexlake.plans.quality import DECLARED
    from apexlake.testbed.build import warehouse

    lake = warehouse(spark, "/root/testdata/sf0.001")
    for name in ("stg_laps", "fct_driver_streaks"):
        expected = lake.table(name).agg(*[c.alias(n) for n, c in checks.measures(name, DECLARED).items()]).first().asDict()
        assert lake.figures(name) == expected
    changed = lake.replaced(stg_laps=lake.table("stg_laps").withColumn("lap", F.lit(None).cast("int")))
    assert changed.figures("stg_laps") is None  # it came from elsewhere: scanned
    line = checks.report(changed.table, checks.Declared({"stg_laps": {"lap": "error"}}, [], {}, [], []), changed.figures).first()
    assert line.violations == lake.table("stg_laps").count()


def test_exchanging_a_table_plans_its_consumers_anew(spark):
    from apexlake.testbed.build import warehouse

    lake = warehouse(spark, "/root/testdata/sf0.001")
    before = lake.table("dim_race").where("has_results").count()
    empty = lake.replaced(stg_results=lake.table("stg_results").limit(0))
    assert before == 80 and empty.table("dim_race").where("has_results").count() == 0
    assert empty.table("stg_races") is lake.table("stg_races")
    assert lake.table("dim_race").where("has_results").count() == 80


def test_each_assertion_is_counted_by_itself(spark):
    """One plan of all assertions, with all their broadcast sides, once filled the driver's memory."""
    rows = spark.createDataFrame([(1,), (2,), (3,)], "n int")
    assertions = {f"A{i:02d}": (lambda t, i=i: t("rows").where(F.col("n") > i).join(F.broadcast(t("rows")), "n"), "error") for i in range(4)}
    report = checks.assertion_report(lambda name: rows, assertions)
    assert {row["target"]: row["violations"] for row in report.collect()} == {"A00": 3, "A01": 2, "A02": 1, "A03": 0}
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1

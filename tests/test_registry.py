"""Everything promised is registered, and a sample agrees with its SQL."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from apexlake.plans import quality
from apexlake.plans.assertions import ASSERTIONS
from apexlake.plans.warehouse import INPUTS, MODELS
from apexlake.testbed.registry import QUERIES
from compare import connect, normal

FOLDER = "/root/testdata/sf0.001"


def test_every_item_is_registered():
    assert len(MODELS) == 9 + 4 + 13
    expected = [*MODELS]
    expected += [f"check_A{n:02d}" for n in range(1, 29)] + [f"check_A{n:02d}_damaged" for n in range(1, 29)]
    expected += [f"measure_R{n:02d}" for n in range(1, 40)] + [f"view_V{n:02d}" for n in range(1, 16)]
    assert set(expected) <= set(QUERIES)
    assert list(ASSERTIONS) == [f"A{n:02d}" for n in range(1, 29)]
    assert all(query.sql for query in QUERIES.values())


def test_declared_checks_are_complete():
    assert sum(len(c) for c in quality.NOT_NULL.values()) == 114
    assert sum(s == "warn" for c in quality.NOT_NULL.values() for s in c.values()) == 2
    assert (len(quality.UNIQUE), len(quality.COMBINATIONS)) == (6, 21)
    assert (len(quality.RELATIONSHIPS), len(quality.ACCEPTED)) == (21, 4)


def test_inputs_name_what_the_models_read(spark):
    """``INPUTS`` decides what is planned anew when a table is exchanged, so it must be exact."""
    for name, plan in MODELS.items():
        if name.startswith("stg_"):
            continue
        names = set(plan.__code__.co_consts) | set()
        used = {c for c in names if isinstance(c, str) and c.startswith(("stg_", "int_", "dim_", "fct_"))}
        assert used == {i for i in INPUTS[name] if i != "team_colours"}, name


@pytest.fixture(scope="module")
def database():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", [
    "stg_results", "stg_laps", "int_driver_form", "int_teammate_qualifying", "dim_season", "fct_driver_standings",
    "fct_driver_careers", "fct_driver_streaks", "fct_qualifying", "fct_lap_positions", "check_A04", "check_A08_damaged",
    "check_A13", "check_A26_damaged", "dq_relationships", "measure_R02", "measure_R33", "view_V03", "view_V10", "view_V15",
    "land_plan", "land_race_watermarks",
])
def test_same_rows_as_sql(spark, database: duckdb.DuckDBPyConnection, name):
    ours = QUERIES[name].run(spark, FOLDER)
    cursor = database.execute(QUERIES[name].sql)
    columns = [d[0] for d in cursor.description]
    assert normal(ours.columns, ours.collect()) == normal(columns, cursor.fetchall())


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    # Every query of the results engine has its SQL; the training-data queries have it where SQL can express them.
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("without_pipeline", [False, True])
def test_entry_without_the_training_data_operators(tmp_path, without_pipeline):
    """A copy without ``apexlake/llm`` still registers every other query."""
    root = Path(__file__).resolve().parents[1]
    ignored = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(root / "apexlake", tmp_path / "apexlake", ignore=ignored)
    files = ["__spark_entry__.py"] + ([] if without_pipeline else ["corpus_pipeline.py"])
    for name in files:
        if (root / name).exists():
            shutil.copy(root / name, tmp_path / name)
    script = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": ""}, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert [line.split() for line in run.stdout.splitlines()] == [sorted(QUERIES)] * 2

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from apexlake.operators import joins
from apexlake.operators.grouping import accumulate, directed_pairs, latest_attributes
from apexlake.operators.ranking import dense_rank_integers, dense_rank_rows, extreme_rows, number_rows, rank_by_histogram, top_ranked
from apexlake.operators.sequences import islands

from conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, with many equal values."""
    ids = spark.range(0, 6000, numPartitions=6)
    return ids.select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("g"), (F.col("id") * 37 % 101).alias("v")
    ).cache()


def test_number_rows_equals_row_number(skewed):
    order = [F.col("v").desc(), F.col("id")]
    expected = skewed.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert rows(number_rows(skewed, ["g"], order, "n")) == rows(expected)


def test_number_rows_of_a_null_group(spark):
    frame = spark.createDataFrame([(None, 2), (None, 1), (1, 5)], "g int, v int")
    assert rows(number_rows(frame, ["g"], [F.col("v")], "n")) == {(None, 1, 1), (None, 2, 2), (1, 5, 1)}


def test_number_rows_spreads_a_large_group(skewed):
    numbered = number_rows(skewed, ["g"], [F.col("id")], "n")
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    # The only window runs over one row per group and partition, never over the rows themselves.
    assert plan.count("Window") <= 2 and "row_number" not in plan


def test_dense_rank(skewed):
    expected = skewed.withColumn("r", F.dense_rank().over(Window.partitionBy("g").orderBy("v")))
    assert rows(dense_rank_rows(skewed, ["g"], "v", "r").select("id", "g", "v", "r")) == rows(expected)


@pytest.mark.parametrize("limit", [0, 500_000])
def test_histogram_rank_with_and_without_broadcast(skewed, monkeypatch, limit):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", limit)
    expected = skewed.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())))
    got = rank_by_histogram(skewed, "g", "v", "r", distinct_values=5000).select("id", "g", "v", "r")
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("limit", [0, 500_000])
@pytest.mark.parametrize("dense, function", [(False, F.rank), (True, F.dense_rank)])
def test_top_ranked_equals_the_window(skewed, monkeypatch, limit, dense, function):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", limit)
    window = Window.partitionBy("g").orderBy(F.col("v").desc())
    expected = skewed.withColumn("p", function().over(window)).where("p <= 25")
    got = top_ranked(skewed, ["g"], "v", 25, groups=50, dense=dense, out="p").select("id", "g", "v", "p")
    assert rows(got) == rows(expected)


def test_top_ranked_keeps_ties_and_drops_unknowns(spark):
    frame = spark.createDataFrame([(1, 9), (1, 9), (1, 5), (1, 1), (1, None)], "g int, v int")
    assert [tuple(r) for r in top_ranked(frame, ["g"], "v", 2, groups=1).collect()] == [(1, 9, 1)] * 2
    best = top_ranked(frame, ["g"], "v", 2, groups=1, ascending=True)
    assert rows(best) == {(1, 1, 1), (1, 5, 2)}


def test_top_ranked_cuts_before_the_shuffle(skewed):
    plan = top_ranked(skewed, ["g"], "v", 3, groups=50)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_extreme_rows(spark):
    frame = spark.createDataFrame([("a", 3), ("b", 1), ("c", 1), ("d", None)], "k string, v int")
    assert rows(extreme_rows(frame, "v", smallest=True)) == {("b", 1), ("c", 1)}


def test_directed_pairs_takes_groups_of_exactly_two(spark):
    frame = spark.createDataFrame(
        [("two", "a", 1), ("two", "b", 2), ("one", "c", 3), ("three", "d", 4), ("three", "e", 5), ("three", "f", 6),
         ("same", "g", 7), ("same", "g", 8)], "team string, driver string, x int")
    got = directed_pairs(frame, ["team"], "driver", ["x"])
    assert rows(got) == {("two", "a", 1, "b", 2), ("two", "b", 2, "a", 1)}


def test_accumulate_keeps_keys_of_either_source(spark):
    a = spark.createDataFrame([(1, 10.0), (2, 5.0)], "k int, race double")
    b = spark.createDataFrame([(2, 1.0), (3, 8.0)], "k int, sprint double")
    got = accumulate([a, b], ["k"], race=F.sum("race"), sprint=F.sum("sprint"))
    assert rows(got) == {(1, 10.0, None), (2, 5.0, 1.0), (3, None, 8.0)}


def test_latest_attributes_null_or_last_known(spark):
    frame = spark.createDataFrame([("x", 2000, "old", "OLD"), ("x", 2001, None, None)],
                                  "id string, season int, name string, code string")
    got = latest_attributes(frame, "id", ["season"], {"name": "name"}, {"code": "code"}, seasons=F.count("*"))
    assert rows(got) == {("x", None, "OLD", 2)}


def test_islands_number_runs_per_flag(spark):
    frame = spark.createDataFrame([("d", n, won, None) for n, won in enumerate([True, True, False, True], 1)],
                                  "driver string, n int, won boolean, never boolean")
    runs = islands(frame, "driver", ["n"], {"win": "won", "none": "never"}, keep=["n"])
    lengths = runs.groupBy("run_type", "run").agg(F.count("*").alias("c"), F.max("is_newest").alias("open"))
    assert rows(lengths) == {("win", 0, 2, False), ("win", 1, 1, True)}


def test_dense_rank_of_integers(spark, tmp_path, monkeypatch):
    """As the window gives it, over several blocks, with nulls and negative numbers, and without a written copy."""
    from apexlake import session
    from apexlake.operators import ranking

    monkeypatch.setattr(ranking, "BLOCK", 10)
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    frame = spark.range(400).select(
        (F.col("id") % 3).alias("g"), F.when(F.col("id") % 7 > 0, F.pmod(F.col("id") * 37, F.lit(91)) - 30).cast("int").alias("v"), "id")
    order = Window.partitionBy("g").orderBy("v")
    expected = frame.where("v IS NOT NULL").withColumn("r", F.dense_rank().over(order)).unionByName(
        frame.where("v IS NULL").withColumn("r", F.lit(None).cast("int")))
    columns = ["g", "v", "id", "r"]
    assert rows(dense_rank_integers(frame, ["g"], "v", "r").select(*columns)) == rows(expected.select(*columns))
    assert not list(tmp_path.iterdir())

"""Race-shaped data derived from the general test tables.

The provided tables hold orders, not races, so this maps them: an order is a
car in a race (its month), the customer is the driver, twelve neighbouring
customers form a team, the lines of a driver's orders in a race are their laps. The
values are chosen so that every branch of the models has rows: shared drives,
retirements, pit-lane starts, missing times, dropped scores, sprints without a
race, seasons still running. ``oracle.py`` states the same mapping in SQL.

Positions are numbered with ``number_rows``: there are only a few dozen races
however many orders there are, so a window per race would not spread. The cars
of one driver in one race, and the lines of a car, are few and take a window.

An endpoint is its rows and a column, the JSON ``item`` of a row. Items are
several times as large as what they are made of, so rows are sorted and moved
without them, and paging makes them where the pages are packed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from apexlake.operators.ranking import number_rows
from apexlake.session import write_once

RACE = ["season", "round"]

# Rule changes moved into the years the test tables cover.
LAST_DROPPED_SCORE_SEASON = 1997
AGGREGATE_QUALIFYING_SEASON = 1996
FIRST_KNOCKOUT_SEASON = 1998
COUNTED_RESULTS = 2

Endpoint = tuple[DataFrame, Column]  # rows, and the item of a row

NAMED_TEAMS = {0: "ferrari", 1: "mclaren", 2: "williams", 3: "red_bull", 4: "mercedes", 5: "haas"}


def _whole(column: Column | str, by: int) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.floor(value / by).cast("long")


def _text(value) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def _driver(key: Column | str = "ckey") -> Column:
    return F.concat(F.lit("d"), _text(key))


def _team(key: Column) -> Column:
    number = _whole(key, 12)
    named = F.coalesce(*[F.when(number == n, F.lit(name)) for n, name in NAMED_TEAMS.items()])
    return F.coalesce(named, F.concat(F.lit("team_"), _text(number)))


def _team_name(number: Column) -> Column:
    renamed = F.when(F.col("season") >= 1998, " GP").otherwise("")
    return F.concat(F.lit("Team "), _text(number), renamed)


def _team_nationality(number: Column) -> Column:
    return F.concat(F.lit("NATION_"), _text(number % 25))


def _clock(ms: Column) -> Column:
    return F.format_string("%d:%02d.%03d", _whole(ms, 60000), _whole(ms, 1000) % 60, ms.cast("long") % 1000)


def _race_points(finish: Column) -> Column:
    return F.when((F.col("st") == "P") | (finish > 60), 0.0).otherwise((61 - finish) / 2)


def _sprint_points(finish: Column) -> Column:
    return F.greatest(17 - finish, F.lit(0))


def _session_times() -> dict[str, Column]:
    """Milliseconds in each qualifying session, by the car's number."""
    k = F.col("okey")
    ran = k % 50 != 0
    return {
        "q1": F.when(ran, 90000 + k * 7 % 5000),
        "q2": F.when(ran & (k % 3 != 0), 88000 + k * 11 % 5000),
        "q3": F.when(ran & (k % 3 == 1), 87000 + k * 13 % 5000),
    }


def _constructor(key: Column) -> Column:
    number = _whole(key, 12)
    return F.struct(
        _team(key).alias("constructorId"), _team_name(number).alias("name"),
        _team_nationality(number).alias("nationality"),
    )


@dataclass
class Projection:
    """Per endpoint, rows (the scope columns, an order for paging, what items are made of) and the JSON ``item``."""

    spark: SparkSession
    folder: str

    def source(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def orders(self) -> DataFrame:
        return self.source("orders").select(
            F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("round"),
            F.col("o_orderkey").alias("okey"), F.col("o_custkey").alias("ckey"),
            F.col("o_orderstatus").alias("st"), F.col("o_totalprice").alias("price"),
            F.col("o_orderpriority").alias("prio"),
        )

    def calendar(self) -> DataFrame:
        """Twelve rounds in every season with an order, run or not."""
        rounds = F.explode(F.sequence(F.lit(1), F.lit(12))).alias("round")
        return self.orders().select("season").distinct().select("season", rounds)

    def cars(self) -> DataFrame:
        ordered = number_rows(
            self.orders(), RACE, [F.col("st") == "P", F.col("price").desc(), F.col("okey")], "finish"
        )
        return number_rows(ordered, RACE, [F.col("okey") % 97, F.col("okey")], "slot").withColumn(
            "points", _race_points(F.col("finish"))
        )

    def first_cars(self) -> DataFrame:
        return self.orders().groupBy(*RACE, "ckey").agg(F.min("okey").alias("okey"))

    def build(self) -> dict[str, Callable[[], Endpoint]]:
        """Plans per endpoint; what several of them share is computed once, for the first that needs it."""
        cars, sprints, entries = cache(self.cars), cache(self.sprints), cache(self.entries)
        driven = cache(lambda: self.driven(entries()))
        return {
            "races": self.race_rows,
            "results": lambda: self.result_rows(cars(), entries()),
            "qualifying": self.qualifying_rows,
            "drivers": self.driver_rows,
            "driver_standings": lambda: self.driver_standing_rows(cars(), sprints()),
            "constructor_standings": lambda: self.constructor_standing_rows(cars(), sprints()),
            "sprint": lambda: self.sprint_rows(sprints()),
            "laps": lambda: self.lap_rows(driven()),
            "pit_stops": lambda: self.pit_rows(driven()),
        }

    def race_rows(self) -> Endpoint:
        nations = self.source("nation").join(
            self.source("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).select(F.col("n_nationkey").cast("int").alias("nk"), "n_name", "r_name")
        calendar = self.calendar().withColumn("nk", (F.col("season") * 12 + F.col("round")) % 25)
        rnd = F.col("round")

        def day(offset: int) -> Column:
            return _text(F.date_add(F.make_date("season", "round", F.lit(1)), offset))

        def session(when: Column, offset: int, time: Column) -> Column:
            return F.when(when, F.struct(day(offset).alias("date"), time.alias("time")))

        always = F.lit(True)
        item = F.struct(
            _text("season").alias("season"), _text("round").alias("round"),
            F.concat(F.lit("https://example.org/"), _text("season"), F.lit("/"), _text("round")).alias("url"),
            F.concat(F.lit("Grand Prix of "), F.col("n_name")).alias("raceName"),
            F.struct(
                F.concat(F.lit("circuit_"), _text("nk")).alias("circuitId"),
                F.concat(F.lit("Circuit "), _text("nk")).alias("circuitName"),
                F.struct(
                    _text(F.col("nk") * 3.25 - 40).alias("lat"), _text(F.col("nk") * 7.5 - 90).alias("long"),
                    F.concat(F.lit("City "), _text("nk")).alias("locality"), F.col("r_name").alias("country"),
                ).alias("Location"),
            ).alias("Circuit"),
            day(0).alias("date"),
            F.when(rnd % 4 != 1, F.lit("14:00:00Z")).alias("time"),
            session(always, -2, F.lit("10:30:00Z")).alias("FirstPractice"),
            session(always, -2, F.lit("")).alias("SecondPractice"),
            session(rnd % 2 == 0, -1, F.lit("09:00:00Z")).alias("ThirdPractice"),
            session(always, -1, F.lit("13:00:00Z")).alias("Qualifying"),
            session(rnd % 3 == 0, -1, F.when(F.col("season") >= 1997, F.lit("08:00:00Z"))).alias("Sprint"),
            session(rnd % 6 == 0, -2, F.lit("15:00:00Z")).alias("SprintQualifying"),
        )
        return calendar.join(nations, "nk"), item

    def result_rows(self, cars: DataFrame, entries: DataFrame) -> Endpoint:
        lines = entries.groupBy("okey").agg(F.max(F.col("before") + F.col("lines")).alias("lines"))  # the last lap
        okey, finish, slot = F.col("okey"), F.col("place"), F.col("slot")
        classified = F.col("st") != "P"
        grid = F.when(okey % 20 == 0, 0).when(okey % 50 != 7, slot)
        millis = 5400000 + finish * 1000 + okey % 1000
        elapsed = F.format_string(
            "%d:%02d:%02d.%03d", _whole(millis, 3600000), _whole(millis, 60000) % 60,
            _whole(millis, 1000) % 60, millis % 1000,
        )
        behind = F.format_string("+%d.%03d", finish - 1, okey % 1000)
        lap = 85000 + slot * 37 + okey % 1000
        speed = F.when(okey % 11 != 0, F.struct(
            F.lit("kph").alias("units"),
            F.concat(_text(200 + _whole(okey % 500, 10)), F.lit("."), _text(okey % 10)).alias("speed"),
        ))
        status = F.when(F.col("st") == "F", "Finished").when(F.col("st") == "O", "+1 Lap").otherwise("Retired")
        item = F.struct(
            _text(okey).alias("number"), _text(finish).alias("position"),
            F.when(classified, _text(finish)).otherwise("R").alias("positionText"),
            _text(_race_points(finish)).alias("points"),
            F.struct(_driver().alias("driverId")).alias("Driver"),
            _constructor(F.col("ckey")).alias("Constructor"),
            _text(grid).alias("grid"), _text(F.coalesce("lines", F.lit(0))).alias("laps"), status.alias("status"),
            F.when(classified, F.struct(
                _text(millis).alias("millis"), F.when(finish == 1, elapsed).otherwise(behind).alias("time")
            )).alias("Time"),
            F.when(F.col("season") >= 1997, F.struct(
                _text(slot).alias("rank"), _text(1 + okey % 50).alias("lap"),
                F.struct(_clock(lap).alias("time")).alias("Time"), speed.alias("AverageSpeed"),
            )).alias("FastestLap"),
        )
        rows = cars.join(lines, "okey", "left")
        return rows.select(*RACE, F.col("finish").alias("place"), "okey", "ckey", "st", "slot", "lines"), item

    def sprints(self) -> DataFrame:
        entries = (
            self.orders().where((F.col("prio") == "1-URGENT") & F.col("round").isin(2, 5, 8, 11))
            .groupBy("season", (F.col("round") + 1).alias("round"), "ckey")
            .agg(F.min(F.struct("okey", "price")).alias("car"))
            .select(*RACE, "ckey", "car.okey", "car.price")
        )
        placed = number_rows(entries, RACE, [F.col("price").desc(), F.col("okey")], "finish")
        return placed.withColumn("points", _sprint_points(F.col("finish")))

    def sprint_rows(self, sprints: DataFrame) -> Endpoint:
        okey = F.col("okey")
        item = F.struct(
            _text(okey).alias("number"), _text("place").alias("position"), _text("place").alias("positionText"),
            _text(_sprint_points(F.col("place"))).alias("points"),
            F.struct(_driver().alias("driverId")).alias("Driver"),
            _constructor(F.col("ckey")).alias("Constructor"),
            _text(1 + okey % 20).alias("grid"), _text(10 + okey % 5).alias("laps"), F.lit("Finished").alias("status"),
        )
        return sprints.select(*RACE, F.col("finish").alias("place"), "okey", "ckey"), item

    def qualifying_rows(self) -> Endpoint:
        k, times = F.col("okey"), _session_times()
        placed = number_rows(
            self.first_cars(), RACE, [times[q].asc_nulls_last() for q in ("q3", "q2", "q1")] + [k], "place"
        )
        item = F.struct(
            _text(k).alias("number"), _text("place").alias("position"),
            F.struct(_driver().alias("driverId")).alias("Driver"),
            _constructor(F.col("ckey")).alias("Constructor"),
            *[F.when(time.isNotNull(), _clock(time)).alias(q.upper()) for q, time in times.items()],
        )
        return placed.select(*RACE, "place", "okey", "ckey"), item

    def driver_rows(self) -> Endpoint:
        customers = self.source("customer").join(
            self.source("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ).select(F.col("c_custkey").alias("ckey"), "c_name", "n_name")
        key, season = F.col("place"), F.col("season")
        year = F.when(key % 100 == 3, 1990).otherwise(1955 + key % 20).cast("int")
        born = F.make_date(year, (1 + key % 12).cast("int"), (1 + key % 28).cast("int"))
        item = F.struct(
            _driver(key).alias("driverId"),
            F.when(season >= 1997, _text(key % 100)).alias("permanentNumber"),
            F.when(season.between(1998, 2000), F.format_string("C%03d", key % 1000)).alias("code"),
            F.concat(F.lit("https://example.org/d/"), _text(key)).alias("url"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("givenName"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("familyName"),
            F.when(key % 50 != 9, _text(born)).alias("dateOfBirth"),
            F.col("n_name").alias("nationality"),
        )
        seasons = self.orders().select("season", "ckey").distinct()
        return seasons.join(customers, "ckey").select("season", F.col("ckey").alias("place"), "c_name", "n_name"), item

    def driver_standing_rows(self, cars: DataFrame, sprints: DataFrame) -> Endpoint:
        per_race = cars.groupBy("season", "ckey", "round").agg(
            F.sum("points").alias("points"),
            F.count_if((F.col("finish") == 1) & (F.col("st") != "P")).alias("wins"),
        )
        # At most twelve rows per driver and season.
        best = Window.partitionBy("season", "ckey").orderBy(F.col("points").desc(), "round")
        counts = (F.row_number().over(best) <= COUNTED_RESULTS) | (F.col("season") > LAST_DROPPED_SCORE_SEASON)
        races = per_race.withColumn("counted", F.when(counts, F.col("points")).otherwise(0.0)).select(
            "season", "ckey", "counted", "wins"
        )
        sprint = sprints.select("season", "ckey", F.col("points").cast("double").alias("counted"), F.lit(0).alias("wins"))
        totals = races.unionByName(sprint).groupBy("season", "ckey").agg(
            F.sum("counted").alias("total"), F.sum("wins").alias("wins")
        )
        placed = number_rows(
            totals, ["season"], [F.col("total").desc(), F.col("wins").desc(), F.col("ckey")], "place"
        )
        finals = self.orders().groupBy("season").agg(F.max("round").alias("round"))
        out = F.col("ckey") % 211 == 7
        teams = F.when(
            F.col("ckey") % 10 == 0, F.array(_constructor(F.col("ckey")), _constructor(F.col("ckey") + 12))
        ).otherwise(F.array(_constructor(F.col("ckey"))))
        item = F.struct(
            F.when((F.col("total") > 0) & ~out, _text("place")).alias("position"),
            F.when(F.col("total") == 0, "-").when(out, "D").otherwise(_text("place")).alias("positionText"),
            _text("total").alias("points"), _text("wins").alias("wins"),
            F.struct(_driver().alias("driverId")).alias("Driver"), teams.alias("Constructors"),
        )
        return placed.join(F.broadcast(finals), "season").select(*RACE, "place", "ckey", "total", "wins"), item

    def constructor_standing_rows(self, cars: DataFrame, sprints: DataFrame) -> Endpoint:
        team = _whole("ckey", 12).alias("team")
        won = F.when((F.col("finish") == 1) & (F.col("st") != "P"), 1).otherwise(0).alias("wins")
        scored = cars.select("season", team, "points", won).unionByName(
            sprints.select("season", team, F.col("points").cast("double").alias("points"), F.lit(0).alias("wins"))
        )
        totals = scored.groupBy("season", "team").agg(F.sum("points").alias("total"), F.sum("wins").alias("wins"))
        placed = number_rows(totals, ["season"], [F.col("total").desc(), F.col("team")], "place")
        finals = self.orders().groupBy("season").agg(F.max("round").alias("round"))
        out = F.col("team") % 53 == 5
        item = F.struct(
            F.when((F.col("total") > 0) & ~out, _text("place")).alias("position"),
            F.when(F.col("total") == 0, "-").when(out, "E").otherwise(_text("place")).alias("positionText"),
            _text("total").alias("points"), _text("wins").alias("wins"),
            _constructor(F.col("team") * 12).alias("Constructor"),
        )
        return placed.join(F.broadcast(finals), "season").select(*RACE, "place", "team", "total", "wins"), item

    def entries(self) -> DataFrame:
        """A row per car that has lines: how often it is entered, its lines in all, and those of the driver's earlier cars in the race."""
        lines = self.source("lineitem").groupBy(F.col("l_orderkey").alias("okey")).agg(F.count("*").alias("lines"))
        entered = self.orders().groupBy(*RACE, "ckey", "okey").agg(F.count("*").alias("times")).join(lines, "okey")
        earlier = Window.partitionBy(*RACE, "ckey").orderBy("okey").rowsBetween(Window.unboundedPreceding, -1)
        driven = (F.col("times") * F.col("lines")).alias("lines")
        counted = entered.select(*RACE, "ckey", "okey", "times", driven)
        return write_once(counted.withColumn("before", F.coalesce(F.sum("lines").over(earlier), F.lit(0))), "entries")

    def driven(self, entries: DataFrame) -> DataFrame:
        """Lines numbered over a driver's cars in a race. They are numbered within the car where they meet it, so they move once."""
        order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag"]
        lines = self.source("lineitem").select(F.col("l_orderkey").alias("okey"), *order)
        entered = lines.join(entries, "okey").withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
        car = Window.partitionBy("okey", *RACE, "ckey").orderBy(*order)
        lap = F.col("before") + F.row_number().over(car)
        return write_once(entered.withColumn("lap", lap).drop("l_linenumber", "times", "time", "lines", "before"), "driven")

    def lap_rows(self, driven: DataFrame) -> Endpoint:
        laps = number_rows(
            driven.drop("l_quantity", "l_returnflag"), [*RACE, "lap"], [F.col("l_extendedprice").desc(), F.col("okey")], "place"
        )
        part = F.col("l_partkey")
        item = F.struct(
            _driver().alias("driverId"),
            F.when(part % 500 != 0, _text("place")).alias("position"),
            F.when(part % 333 == 0, "no time")
            .otherwise(_clock(80000 + (part * 31 + F.col("l_suppkey")) % 20000)).alias("time"),
        )
        return laps.select(*RACE, "lap", "place", "ckey", "l_partkey", "l_suppkey"), item

    def pit_rows(self, driven: DataFrame) -> Endpoint:
        own = Window.partitionBy(*RACE, "ckey").orderBy("lap")
        stops = driven.where(F.col("l_returnflag") == "R").withColumn("stop", F.row_number().over(own))
        ms = 20000 + (F.col("l_quantity") * 1000).cast("long") + F.col("l_suppkey") % 1000
        bare = F.format_string("%d.%03d", _whole(ms, 1000), ms % 1000)
        item = F.struct(
            _driver().alias("driverId"), _text("lap").alias("lap"), _text("stop").alias("stop"),
            F.format_string("14:%02d:%02d", F.col("lap") % 60, F.col("l_suppkey") % 60).alias("time"),
            F.when(ms >= 60000, _clock(ms)).otherwise(bare).alias("duration"),
        )
        return stops.select(*RACE, "lap", "okey", "stop", "ckey", "l_suppkey", "l_quantity"), item

"""Raw pages: page accounting, validation and replacing whole scopes.

A scope is a season, or a race for the endpoints fetched race by race. Its
pages are replaced as one: new pages go to a directory of their own, then one
line in the ``loads`` log makes them current. Readers follow the log, so they
see the old pages or the new ones, never a mix, also when a job dies half-way.
A scope that was requested and came back empty gets a line without pages,
which hides the stale ones.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apexlake.operators.joins import measured_side
from apexlake.session import LARGE_ROWS, read_if_there, remove
from apexlake.sources.schemas import PAGING, RACE_PAGE, SEASON_PAGE
from apexlake.sources.waiting import Delivery, WaitingArea

MAX_PAGE_LIMIT = 100
PLANNED_AT_ONCE = 10_000
PAGES_PER_FILE = 2_000  # about 180 MB of payload at 90 KB a page


def rows_on_page(limit: Column, total: Column, offset: Column) -> Column:
    """Rows a page contributes: the last page holds what is left, never less than none."""
    return F.greatest(F.lit(0), F.least(limit, total - offset))


def file_slot(offset: Column, limit: Column) -> Column:
    """Which of its scope's files a page goes to."""
    return F.floor(offset / (limit * PAGES_PER_FILE))


def _with_offsets(scopes: DataFrame) -> DataFrame:
    """One row per page of every scope with a ``total_rows`` and a ``page_limit``.

    Spread in two steps, so that a scope of millions of pages never builds one
    array of all its offsets.
    """
    total, limit = F.col("total_rows").cast("bigint"), F.col("page_limit").cast("bigint")
    stretch = limit * PLANNED_AT_ONCE
    starts = scopes.where(F.col("total_rows") > 0).withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), total - 1, stretch)))
    until = F.least(F.col("_from") + stretch, total) - 1
    offsets = F.explode(F.sequence(F.col("_from"), until, limit))
    return starts.withColumn("page_offset", offsets).withColumn("page_offset", F.col("page_offset").cast("int")).drop("_from")


def page_plan(scopes: DataFrame, limit: int = MAX_PAGE_LIMIT) -> DataFrame:
    """One row per page to expect for every scope with a ``total_rows``; none where it is 0."""
    return _with_offsets(scopes.withColumn("page_limit", F.lit(min(limit, MAX_PAGE_LIMIT))))


def highest_round(payload: Column) -> Column:
    """Highest round named in a page; null for endpoints without rounds."""
    schema = "struct<MRData:struct<RaceTable:struct<Races:array<struct<round:string>>>>>"
    races = F.from_json(payload, schema)["MRData"]["RaceTable"]["Races"]
    return F.array_max(F.transform(races, lambda race: race["round"].try_cast("int")))


def validate(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split pages into readable ones and rejects.

    A payload that does not parse would explode into nothing without a trace,
    so a page must carry a numeric total before it may land.
    """
    total = F.from_json("payload", PAGING)["MRData"]["total"].try_cast("int")
    return pages.where(total.isNotNull()), pages.where(total.isNull())


def missing_pages(pages: DataFrame, scope: list[str]) -> DataFrame:
    """Pages the paging fields promise that did not arrive.

    Pages are counted per scope first; only scopes that come out short are
    compared page by page.
    """
    arrived = pages.groupBy(*scope, "page_offset").agg(
        F.max("total_rows").alias("total_rows"), F.max("page_limit").alias("page_limit")
    )
    in_plan = (F.col("page_offset") < F.col("total_rows")) & (F.col("page_offset") % F.col("page_limit") == 0)
    scopes = arrived.groupBy(*scope).agg(
        F.max("total_rows").alias("total_rows"), F.max("page_limit").alias("page_limit"), F.count_if(in_plan).alias("n")
    )
    short = scopes.where(F.col("n") < F.ceil(F.col("total_rows") / F.col("page_limit")))
    planned = _with_offsets(short).select(*scope, "page_offset")
    return planned.join(arrived.select(*scope, "page_offset"), [*scope, "page_offset"], "left_anti")


@dataclass
class RawTable:
    """Landed pages of one endpoint."""

    spark: SparkSession
    path: str
    per_race: bool = False

    @property
    def scope(self) -> list[str]:
        return ["season", "round"] if self.per_race else ["season"]

    @property
    def _scope_fields(self) -> list[T.StructField]:
        return [self.schema[c] for c in self.scope]

    @property
    def schema(self) -> T.StructType:
        return RACE_PAGE if self.per_race else SEASON_PAGE

    @property
    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("load_id", T.StringType())])

    @property
    def _log(self) -> T.StructType:
        return T.StructType([
            *self._scope_fields, T.StructField("load_id", T.StringType()), T.StructField("at", T.TimestampType()),
            T.StructField("upto", T.LongType()), T.StructField("delivery", T.StringType()),
            T.StructField("ingested_at", T.TimestampType()),
        ])

    def replace(
        self, pages: DataFrame, requested: DataFrame, load_id: str, ingested_at: Column | None = None,
        delivery: Delivery | None = None, together: bool = False,
    ) -> None:
        """Make ``pages`` the content of every ``requested`` scope.

        Other scopes stay as they are. One timestamp is stamped on the whole
        load. Every attempt writes files of its own, whatever load it belongs
        to, and the newest attempt of a scope counts: a retried job or stream
        batch neither duplicates pages nor brings old ones back. Of the pages that
        wait for these scopes, those up to ``delivery`` are used up, or all that
        have arrived if the load is not one of a stream. ``together`` says that the
        pages of a scope's file (``file_slot``) are in one partition already.
        """
        upto = delivery.number if delivery else self.waiting.newest()
        load_id = f"{load_id}-{uuid.uuid4().hex[:12]}"
        at = ingested_at if ingested_at is not None else F.lit(self._now())
        wanted = requested.select(*self.scope).distinct()
        columns = [c for c in self.schema.names if c != "ingested_at"]
        stamped = (
            pages.select(*[F.col(c).cast(self.schema[c].dataType) for c in columns])
            .join(measured_side(wanted), self.scope, "left_semi")
            .withColumn("ingested_at", at)
            .withColumn("load_id", F.lit(load_id))
        )
        # A scope is written by as many tasks as it has files, so one that
        # holds a third of all pages does not end in a single task.
        slot = file_slot(F.col("page_offset"), F.col("page_limit"))
        (
            (stamped if together else stamped.repartition(*[F.col(c) for c in self.scope], slot))
            .write.mode("overwrite").options(partitionOverwriteMode="dynamic", **LARGE_ROWS)
            .partitionBy("load_id", *self.scope).parquet(f"{self.path}/pages")
        )
        line = wanted.select(
            *self.scope, F.lit(load_id).alias("load_id"), F.lit(self._now()).alias("at"), F.lit(upto).cast("bigint").alias("upto"),
            F.lit(delivery.name if delivery else None).cast("string").alias("delivery"), at.alias("ingested_at"))
        line.coalesce(1).write.mode("append").parquet(f"{self.path}/loads")

    def _now(self):
        return self.spark.sql("SELECT current_timestamp() AS at").first()["at"]

    def keep_failures(self, failures: DataFrame, load_id: str) -> None:
        """Add a load's failed scopes to the table's list of failures."""
        line = failures.select(*self.scope, "reason", F.lit(load_id).alias("load_id"), F.lit(self._now()).alias("at"))
        line.write.mode("append").parquet(f"{self.path}/failures")

    def keep_rejects(self, pages: DataFrame, load_id: str) -> None:
        """Keep unreadable pages as they came, beside the table."""
        columns = [c for c in self.schema.names if c != "ingested_at"]
        rejects = pages.select(*columns, F.lit(load_id).alias("load_id"), F.lit(self._now()).alias("at"))
        rejects.write.mode("append").options(**LARGE_ROWS).parquet(f"{self.path}/rejects")

    def failures(self) -> DataFrame:
        """Every scope that failed, by load: scope, reason, load_id, at."""
        return self._kept("failures", [*self._scope_fields, T.StructField("reason", T.StringType())])

    def rejects(self) -> DataFrame:
        """Every page that could not be read, by load."""
        return self._kept("rejects", [f for f in self.schema.fields if f.name != "ingested_at"])

    def _kept(self, folder: str, fields: list[T.StructField]) -> DataFrame:
        by_load = [T.StructField("load_id", T.StringType()), T.StructField("at", T.TimestampType())]
        schema = T.StructType([*fields, *by_load])
        kept = read_if_there(self.spark, schema, f"{self.path}/{folder}")
        return kept if kept is not None else self.spark.createDataFrame([], schema)

    @property
    def waiting(self) -> WaitingArea:
        """Delivered pages of scopes that are not complete yet."""
        columns = T.StructType([f for f in self.schema.fields if f.name != "ingested_at"])
        return WaitingArea(self.spark, self.path, self.scope, columns)

    def arrive(self, pages: DataFrame, delivery: Delivery) -> DataFrame:
        """Add a delivery to the pages that wait; returns all open ones in the scopes it touches.

        A scope's pages may come in several deliveries, of several streams. They
        wait until the scope lands, by whatever kind of load; what came before
        that landing is used up. A page without a scope or place waits for
        nothing: it goes to the rejects.
        """
        placed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*self.scope, "page_offset")])
        seen = pages.select(*self.scope, placed.alias("placed")).distinct().collect()  # at most the races on the calendar
        if any(not row["placed"] for row in seen):
            self.keep_rejects(pages.where(~placed), delivery.name)
        scopes = sorted(tuple(row)[:-1] for row in seen if row["placed"])
        if scopes:
            self.waiting.store(pages.where(placed), delivery)
        return self.waiting.open_pages(scopes, self.used(delivery.name))

    def used(self, but: str | None = None) -> DataFrame:
        """Per scope, the number of the newest delivery that a landing used up, leaving out those one delivery led to.

        A delivery that is repeated because its landing broke off must find its pages open.
        """
        log = self._lines()
        own = F.lit(False) if but is None else F.col("delivery").eqNullSafe(F.lit(but))
        return log.where(~own).groupBy(*self.scope).agg(F.max("upto").alias("upto"))

    def remove_used(self, scopes: DataFrame) -> None:
        """Delete waiting pages of some scopes that landings have used up."""
        self.waiting.remove_used([tuple(row) for row in self.used().join(scopes.distinct(), self.scope).collect()])

    def _showing(self) -> list[str]:
        return [row["load_id"] for row in self.loads().select("load_id").distinct().collect()]

    def remove_superseded(self) -> None:
        """Delete the files of loads that no scope shows any more. Not while readers or loads are running."""
        stored = read_if_there(self.spark, self._stored, f"{self.path}/pages")
        if stored is None:
            return
        kept = set(self._showing())
        folders = {name[: name.index("/", name.index("load_id="))] for name in stored.inputFiles()}
        for folder in folders:
            if unquote(folder.rsplit("load_id=", 1)[1]) not in kept:
                remove(self.spark, folder)

    def _lines(self) -> DataFrame:
        log = read_if_there(self.spark, self._log, f"{self.path}/loads")
        return log if log is not None else self.spark.createDataFrame([], self._log)

    def landings(self) -> DataFrame:
        """When which scopes were landed: a line per scope and load, without touching a page."""
        return self._lines().select(*self.scope, "load_id", "ingested_at")

    def loads(self) -> DataFrame:
        """The load each scope currently shows."""
        return self._lines().groupBy(*self.scope).agg(F.max_by("load_id", F.struct("at", "load_id")).alias("load_id"))

    def read(self) -> DataFrame:
        """Current pages of every scope. Only folders of loads that still show a scope are read."""
        stored = read_if_there(self.spark, self._stored, f"{self.path}/pages")
        if stored is None:
            return self.spark.createDataFrame([], self.schema)
        current = measured_side(self.loads())
        showing = self._showing()  # at most one load per scope on the calendar
        return stored.where(F.col("load_id").isin(showing)).join(current, [*self.scope, "load_id"], "left_semi").select(*self.schema.names)

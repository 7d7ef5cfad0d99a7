"""Delivered pages that wait until their scope is complete, and what landings have used up of them.

A delivery is one batch of one stream. It gets a number of the table's own when
its pages are stored: streams count their batches from 0 with every new
checkpoint, so their numbers neither tell deliveries apart nor order them. A
repeated batch is recognised by the stream's identity and its batch number and
keeps its delivery number.

Every landing of a scope, by a stream or by hand, says up to which delivery
pages are used up. What waits with a higher number is open. Used pages are
removed once the landing is recorded, so the area holds incomplete scopes only.
A number is claimed with a file that only one writer can create; stores
without exclusive creation need one writer per table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apexlake.session import LARGE_ROWS, claim, names_in, read_if_there, remove

# Lines of the delivery log are folded into one per stream after so many writes.
FOLD_AFTER = 100
# Where a page came from, to order pages of one delivery.
ARRIVAL = T.StructType([T.StructField("file_time", T.TimestampType()), T.StructField("file_name", T.StringType())])
LOG = "source string, batch long, number long, landed boolean"


@dataclass(frozen=True)
class Delivery:
    """One batch of one stream, with its number in the table."""

    number: int
    source: str
    batch: int
    landed: bool = False

    @property
    def name(self) -> str:
        return f"{self.number:012d}-{self.source}-{self.batch}"


def _number(folder: str) -> int:
    return int(folder.rsplit("delivery=", 1)[1].split("-", 1)[0])


@dataclass
class WaitingArea:
    """The pages of one raw table that wait, in folders by scope and delivery."""

    spark: SparkSession
    path: str
    scope: list[str]
    columns: T.StructType

    @property
    def _pages(self) -> str:
        return f"{self.path}/waiting"

    def _log(self) -> DataFrame | None:
        return read_if_there(self.spark, LOG, f"{self.path}/deliveries")

    def _append(self, rows: list[tuple]) -> None:
        lines = self.spark.createDataFrame(rows, LOG).coalesce(1)
        lines.write.parquet(f"{self.path}/deliveries/write={uuid.uuid4().hex}")

    def newest(self) -> int:
        """The highest delivery number given so far, 0 before the first."""
        log = self._log()
        return (log.agg(F.max("number")).first()[0] or 0) if log is not None else 0

    def begin(self, source: str, batch: int) -> Delivery:
        """The delivery of a batch: the one it had before, or one with a new number."""
        log, mine = self._log(), (F.col("source") == source) & (F.col("batch") == batch)
        number = 1
        if log is not None:
            known = log.agg(
                F.min(F.when(mine, F.col("number"))).alias("mine"), F.bool_or(mine & F.col("landed")).alias("landed"),
                F.max("number").alias("newest")).first()
            if known["mine"] is not None:
                return Delivery(known["mine"], source, batch, known["landed"])
            number = known["newest"] + 1
        while not claim(self.spark, f"{self.path}/claims/{number:012d}"):
            number += 1
        self._append([(source, batch, number, False)])
        return Delivery(number, source, batch)

    def settle(self, delivery: Delivery) -> None:
        """Record that everything a delivery leads to is done. A repeat of it changes nothing any more."""
        self._append([(delivery.source, delivery.batch, delivery.number, True)])
        self._fold()

    def _fold(self) -> None:
        """Keep the newest line of each stream: its batches come in order, so earlier ones are not repeated."""
        folder = f"{self.path}/deliveries"
        writes = [name for name in names_in(self.spark, folder) if name.startswith("write=")]
        if len(writes) <= FOLD_AFTER:
            return
        log = self.spark.read.schema(LOG).parquet(*[f"{folder}/{name}" for name in writes])
        newest = log.groupBy("source").agg(F.max(F.struct("batch", "number", "landed")).alias("line"))
        kept = [(row["source"], *row["line"]) for row in newest.collect()]  # one line per stream
        self._append(kept)
        for name in writes:
            remove(self.spark, f"{folder}/{name}")
        top = max(number for _, _, number, _ in kept)
        for name in names_in(self.spark, f"{self.path}/claims"):
            if int(name) < top:
                remove(self.spark, f"{self.path}/claims/{name}")

    def store(self, pages: DataFrame, delivery: Delivery) -> None:
        """Add the pages of a delivery; a repeat overwrites its own."""
        stored = pages.select(*self.columns.names, *ARRIVAL.names).withColumn("delivery", F.lit(delivery.name))
        (
            stored.write.mode("overwrite").options(partitionOverwriteMode="dynamic", **LARGE_ROWS)
            .partitionBy(*self.scope, "delivery").parquet(self._pages)
        )

    def _folder(self, scope: tuple) -> str:
        return "/".join([self._pages, *[f"{c}={v}" for c, v in zip(self.scope, scope)]])

    def in_scopes(self, scopes: list[tuple]) -> DataFrame:
        """What waits in some scopes, with its delivery. Other scopes' folders are not even listed."""
        schema = T.StructType([*self.columns.fields, *ARRIVAL.fields, T.StructField("delivery", T.StringType())])
        if not scopes:
            return self.spark.createDataFrame([], schema)
        folders = [self._folder(scope) for scope in scopes]
        return self.spark.read.schema(schema).option("basePath", self._pages).parquet(*folders)

    def open_pages(self, scopes: list[tuple], used: DataFrame) -> DataFrame:
        """Pages of some scopes that are not used up; of two for one place the later one counts.

        ``used`` has a number ``upto`` per scope. Later is the delivery, then the
        file's time and name; pages level in all that are told apart by content.
        """
        waiting = self.in_scopes(scopes).withColumn("_number", F.split("delivery", "-")[0].cast("bigint"))
        open_ = waiting.join(used, self.scope, "left").where(F.col("upto").isNull() | (F.col("_number") > F.col("upto")))
        place = [*self.scope, "page_offset"]
        rest = [c for c in self.columns.names if c not in place]
        order = F.struct("_number", *ARRIVAL.names, F.xxhash64("payload"))
        latest = open_.groupBy(*place).agg(F.max_by(F.struct(*rest), order).alias("page"))
        return latest.select(*place, "page.*").select(*self.columns.names)

    def remove_used(self, used: list[tuple]) -> None:
        """Delete what is used up: ``used`` lists scopes with the number up to which they are."""
        for *scope, upto in used:
            folder = self._folder(tuple(scope))
            for name in names_in(self.spark, folder):
                if name.startswith("delivery=") and upto is not None and _number(name) <= upto:
                    remove(self.spark, f"{folder}/{name}")

"""Test tables to a warehouse: project, page, land, stage, each when first read. Kept for the life of the session."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from threading import RLock
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apexlake.plans.warehouse import Rules, Warehouse
from apexlake.session import configure, shared_folder, write_once
from apexlake.sources.landing import RawTable
from apexlake.sources.seed import packaged_team_colours
from apexlake.testbed import projection
from apexlake.testbed.paging import PER_RACE, pages

RULES = Rules(
    projection.LAST_DROPPED_SCORE_SEASON,
    projection.AGGREGATE_QUALIFYING_SEASON,
    projection.FIRST_KNOCKOUT_SEASON,
)
LANDED_AT = "2001-09-01 06:00:00"
# Endpoints landed at another time.
LANDED_ALSO = {"sprint": "2001-09-15 06:00:00", "qualifying": "2001-09-12 18:30:00", "laps": "2001-08-10 06:00:00", "pit_stops": "2001-08-05 12:00:00"}
_built: dict[tuple[str, str], Warehouse] = {}


class Landed(Mapping):
    """Landed pages by endpoint, or what ``of`` takes from a table of them. An endpoint is landed when it is first asked for."""

    def __init__(self, land: Callable[[str], RawTable], endpoints: list[str], of: Callable[[RawTable], DataFrame]):
        self._land, self._endpoints, self._of = land, endpoints, of
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, endpoint: str) -> DataFrame:
        if endpoint not in self._endpoints:
            raise KeyError(endpoint)
        if endpoint not in self._known:
            self._known[endpoint] = self._of(self._land(endpoint))
        return self._known[endpoint]

    def __iter__(self) -> Iterator[str]:
        return iter(self._endpoints)

    def __len__(self) -> int:
        return len(self._endpoints)


def landing(spark: SparkSession, folder: str) -> tuple[Callable[[str], RawTable], list[str]]:
    """A function that turns the test tables into the landed raw pages of an endpoint, once, and the endpoints.

    A query of one endpoint does not wait for the pages of the others.
    """
    root = f"{shared_folder(spark)}/raw-{spark.sparkContext.applicationId}-{crc32(folder.encode())}"
    projected = projection.Projection(spark, folder)
    rows = projected.build()
    requested = write_once(projected.calendar(), "calendar")
    tables: dict[str, RawTable] = {}
    alone = RLock()

    def land(endpoint: str) -> RawTable:
        with alone:
            if endpoint not in tables:
                table = RawTable(spark, f"{root}/{endpoint}", per_race=endpoint in PER_RACE)
                projected_rows, item = rows[endpoint]()
                fetched = pages(projected_rows, endpoint, item=item)
                at = F.lit(LANDED_ALSO.get(endpoint, LANDED_AT)).cast("timestamp")
                table.replace(fetched, requested, load_id="first", ingested_at=at, together=True)
                tables[endpoint] = table
            return tables[endpoint]

    return land, list(rows)


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse over one folder of test tables."""
    configure(spark)
    key = (spark.sparkContext.applicationId, folder)
    if key not in _built:
        land, endpoints = landing(spark, folder)
        raw, logs = Landed(land, endpoints, RawTable.read), Landed(land, endpoints, RawTable.landings)
        _built[key] = Warehouse(raw, packaged_team_colours(spark), RULES, logs=logs)
    return _built[key]

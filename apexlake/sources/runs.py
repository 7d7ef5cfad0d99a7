"""A load run: validate, land, record. Watermarks come last, failures stay isolated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apexlake.sources import planning
from apexlake.session import write_once
from apexlake.sources.landing import RawTable, highest_round, missing_pages
from apexlake.sources.planning import LoadState
from apexlake.sources.schemas import PAGING
from apexlake.sources.waiting import Delivery


def checked(pages: DataFrame, scope: list[str]) -> DataFrame:
    """What a load needs to know of each page, without its payload: whether it reads, and the highest round in it."""
    total = F.from_json("payload", PAGING)["MRData"]["total"].try_cast("int")
    return pages.select(
        *scope, "page_offset", "page_limit", "total_rows", total.isNotNull().alias("readable"),
        highest_round(F.col("payload")).alias("payload_round"))


def failed_scopes(pages: DataFrame, scope: list[str]) -> DataFrame:
    """Scopes that must not replace what is landed: an unreadable page, or a page missing. Takes pages, checked or not."""
    looked_at = pages if "readable" in pages.columns else checked(pages, scope)
    unreadable = looked_at.where(~F.col("readable")).select(*scope, F.lit("unreadable page").alias("reason"))
    incomplete = missing_pages(looked_at.where("readable"), scope).select(*scope, F.lit("missing page").alias("reason"))
    return unreadable.unionByName(incomplete).groupBy(*scope).agg(F.max("reason").alias("reason"))


def land(
    endpoint: str, table: RawTable, state: LoadState, pages: DataFrame, requested: DataFrame,
    latest: DataFrame, load_id: str, delivery: Delivery | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Land one endpoint's fetched pages; returns (new watermarks, failures).

    A failing scope is reported, keeps its old pages and gets no watermark, so
    the next run plans it again. The others go through. Payloads are parsed
    once; failures and rejected pages are kept with the table. What waits for the
    landed scopes is used up; it is removed last, when nothing needs it for a
    repeat any more.
    """
    scope = table.scope
    looked_at = write_once(checked(pages, scope), "checked-pages")
    failures = write_once(failed_scopes(looked_at, scope), "failures")
    good = write_once(requested.select(*scope).distinct().join(failures, scope, "left_anti"), "good-scopes")
    fit = pages.join(good, scope, "left_semi")
    if not failures.isEmpty():  # an unreadable page fails its scope
        table.keep_failures(failures, load_id)
        rejected = looked_at.where(~F.col("readable")).select(*scope, "page_offset").distinct()
        table.keep_rejects(pages.join(rejected, [*scope, "page_offset"], "left_semi"), load_id)
    if table.per_race:
        fresh = _land_races(endpoint, table, fit, good, failures, latest, load_id, delivery)
    else:
        table.replace(fit, good, load_id, delivery=delivery)
        fresh = planning.season_watermarks(endpoint, good, looked_at.join(good, scope, "left_semi"), latest)
    fresh = write_once(fresh.select("endpoint", "season", "last_round", "total_rows"), "fresh-watermarks")
    state.upsert(fresh)
    if delivery:
        table.waiting.settle(delivery)
    table.remove_used(good)
    report = failures.select("season", F.lit(endpoint).alias("endpoint"), "reason").distinct()
    return fresh, report


def _land_races(
    endpoint: str, table: RawTable, pages: DataFrame, good: DataFrame, failures: DataFrame, latest: DataFrame, load_id: str,
    delivery: Delivery | None = None,
) -> DataFrame:
    """Replace the races fetched; returns progress and completion of their seasons.

    A newest round that is not published yet keeps whatever is landed for it.
    """
    scope = table.scope
    waiting = planning.round_outcomes(good, pages, latest).where(F.col("outcome") == "unpublished")
    settled = good.join(waiting, scope, "left_anti")
    table.replace(pages, settled, load_id, delivery=delivery)

    landed = table.read().join(good.select("season").distinct(), "season", "left_semi")
    rounds = settled.unionByName(landed.select(*scope)).distinct().join(waiting, scope, "left_anti")
    outcomes = planning.round_outcomes(rounds, landed, latest.limit(0)).unionByName(waiting)
    # A failed round leaves its season open: progress stops before it.
    broken = failures.groupBy("season").agg(F.min("round").alias("broken"))
    outcomes = outcomes.join(broken, "season", "left").where(
        F.col("broken").isNull() | (F.col("round") < F.col("broken"))
    )
    marks = planning.race_watermarks(endpoint, outcomes)
    unfinished = broken.select("season", F.lit(endpoint).alias("endpoint"))
    return marks.join(unfinished, ["endpoint", "season"], "left_anti")


def write_summary(summary: DataFrame, path: str) -> None:
    """The summary row as one JSON file, for whatever started the run."""
    summary.coalesce(1).write.mode("overwrite").json(path)

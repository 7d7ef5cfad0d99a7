"""Pack projected rows into API pages of at most 100 rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apexlake.operators.joins import measured_side
from apexlake.operators.ranking import number_across, number_rows
from apexlake.session import write_once
from apexlake.sources.landing import file_slot

LIMIT = 100

# endpoint -> table, list inside it, list inside each entry (None: the rows themselves)
SHAPES = {
    "races": ("RaceTable", "Races", None),
    "results": ("RaceTable", "Races", "Results"),
    "qualifying": ("RaceTable", "Races", "QualifyingResults"),
    "drivers": ("DriverTable", "Drivers", None),
    "driver_standings": ("StandingsTable", "StandingsLists", "DriverStandings"),
    "constructor_standings": ("StandingsTable", "StandingsLists", "ConstructorStandings"),
    "sprint": ("RaceTable", "Races", "SprintResults"),
    "laps": ("RaceTable", "Races", "Laps"),
    "pit_stops": ("RaceTable", "Races", "PitStops"),
}
# How rows are numbered within their scope: by a column that is the number
# already, by continuing a numbering over rounds or laps, or by sorting.
NUMBERING = {
    "races": ("is", "round"), "results": ("across", "round"), "qualifying": ("across", "round"),
    "drivers": ("sort", ["place"]), "driver_standings": ("is", "place"), "constructor_standings": ("is", "place"),
    "sprint": ("across", "round"), "laps": ("across", "lap"), "pit_stops": ("sort", ["lap", "okey", "stop"]),
}
PER_RACE = ("laps", "pit_stops")


def _in_order(order: list[str], value: Column) -> Column:
    """A list of at most one page of rows, sorted."""
    pairs = F.sort_array(F.collect_list(F.struct(*order, value.alias("value"))))
    return F.transform(pairs, lambda pair: pair["value"])


def pages(
    rows: DataFrame, endpoint: str, request_root: str = "https://example.org/api", item: Column | None = None,
) -> DataFrame:
    """Pages in the shape a landing job receives them, without ``ingested_at``.

    Rows are brought together once, by the file their page will go to; every list
    inside a page is packed there, and a landing has nothing left to move. The
    ``item`` of a row (a column of that name, if none is given) is made there too.
    """
    scope = ["season", "round"] if endpoint in PER_RACE else ["season"]
    how, by = NUMBERING[endpoint]
    if how == "is":
        numbered = rows.withColumn("n", F.col(by))
    elif how == "across":
        numbered = number_across(rows, scope, by, "place", "n")
    else:
        numbered = number_rows(rows, scope, [F.col(c) for c in by], "n")
    offset = (F.floor((F.col("n") - 1) / LIMIT) * LIMIT).cast("int")
    table, listing, detail = SHAPES[endpoint]
    totals = numbered.groupBy(*scope).agg(F.max("n").cast("int").alias("total_rows"))
    moved = numbered.withColumn("file", file_slot(offset, F.lit(LIMIT))).repartition(*scope, "file")
    numbered = moved.withColumns({"page_offset": offset, "item": F.col("item") if item is None else item})
    page = [*scope, "page_offset", "file"]
    if detail is None:
        packed = numbered.groupBy(*page).agg(_in_order(["n"], F.col("item")).alias("entries"))
    else:
        level = [*dict.fromkeys([*page, "round"])]
        if endpoint == "laps":
            timings = numbered.groupBy(*level, "lap").agg(_in_order(["n"], F.col("item")).alias("timings"))
            numbered = timings.select(
                *level, F.col("lap").alias("n"),
                F.struct(F.col("lap").cast("string").alias("number"), F.col("timings").alias("Timings")).alias("item"),
            )
        entries = numbered.groupBy(*level).agg(_in_order(["n"], F.col("item")).alias("detail"))
        header = F.struct(
            F.col("season").cast("string").alias("season"), F.col("round").cast("string").alias("round"),
            F.col("detail").alias(detail),
        )
        packed = entries.groupBy(*page).agg(
            F.transform(F.sort_array(F.collect_list(F.struct(F.col("round").alias("r"), header.alias("value")))),
                        lambda pair: pair["value"]).alias("entries"),
        )
    whole = packed.join(measured_side(write_once(totals, f"totals-{endpoint}")), scope)
    envelope = F.struct(F.struct(
        F.lit(str(LIMIT)).alias("limit"), F.col("page_offset").cast("string").alias("offset"),
        F.col("total_rows").cast("string").alias("total"),
        F.struct(F.col("entries").alias(listing)).alias(table),
    ).alias("MRData"))
    url = F.concat_ws("/", F.lit(request_root), *[F.col(c) for c in scope],
                      F.concat(F.lit(f"{endpoint}/?limit={LIMIT}&offset="), F.col("page_offset")))
    return whole.select(
        *scope, "page_offset", F.lit(LIMIT).alias("page_limit"), "total_rows",
        url.alias("request_url"), F.to_json(envelope).alias("payload"),
    )

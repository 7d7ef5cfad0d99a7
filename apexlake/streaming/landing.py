"""Continuous landing: page files dropped in a folder become current raw pages."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from apexlake.session import LARGE_ROWS, write_once
from apexlake.sources.landing import RawTable
from apexlake.sources.planning import LoadState
from apexlake.sources.runs import land

CORRUPT = "_corrupt_line"


def incoming_schema(table: RawTable) -> T.StructType:
    """A page as delivered: the raw columns before landing stamps its time."""
    return T.StructType([f for f in table.schema.fields if f.name != "ingested_at"])


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gives a stream with its checkpoint: the same after a restart, another for every new checkpoint."""
    return json.loads("".join(row["value"] for row in spark.read.text(f"{checkpoint}/metadata").collect()))["id"]


def land_new_files(
    spark: SparkSession, endpoint: str, folder: str, table: RawTable, state: LoadState,
    latest: DataFrame, checkpoint: str,
) -> StreamingQuery:
    """Process every file not seen before, then stop.

    Arriving pages are stored first and land when their scope is complete, so a
    scope may be spread over files, batches, runs and streams. What fails
    meanwhile is listed with the table; a line that is no page goes to the
    rejects as it came. A batch that is replayed after a failure overwrites what
    it stored, lands again if its landing broke off, and changes nothing if it
    had been done. Other loads of the same table may come between.
    """
    delivered = T.StructType([*incoming_schema(table).fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.readStream.schema(delivered).option("columnNameOfCorruptRecord", CORRUPT).json(folder)
    stream = lines.withColumn("payload", F.coalesce("payload", CORRUPT)).select(
        *incoming_schema(table).names, F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_name").alias("file_name"))

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        delivery = table.waiting.begin(stream_identity(spark, checkpoint), batch_id)
        if delivery.landed:
            table.remove_used(batch.select(*table.scope))
            return
        kept = batch.persist()
        pages = write_once(table.arrive(kept, delivery), "arrived", **LARGE_ROWS)
        kept.unpersist()
        land(endpoint, table, state, pages, pages.select(*table.scope), latest, f"{endpoint}-delivery-{delivery.name}", delivery)

    return (
        stream.writeStream.foreachBatch(land_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

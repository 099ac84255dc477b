"""Incremental sync fed by files instead of a database: a stream over a landing folder."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillmark.sources.sync import add_batch


def follow_landing(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    base: str,
    table: str,
    checkpoint: str,
    glob: str | None = None,
    files_per_batch: int = 1000,
) -> None:
    """Take in all files that arrived since the last call, then stop.

    Every micro-batch is a batch named by its query and number, so one repeated after a failure
    takes the place of the first. The query's id comes from the offsets folder: with a
    new or lost one all files are taken again, beside the batches already there. Read the result
    with ``read_synced`` and a key to get the current rows.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)

    def store(batch: DataFrame, number: int) -> None:
        told = batch.sparkSession.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0]
        query = json.loads(told)["id"]
        add_batch(batch, base, table, f"stream-{query}-{number}")

    (
        reader.parquet(landing)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )

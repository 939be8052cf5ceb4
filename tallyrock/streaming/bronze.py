"""Message stream to Bronze."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallyrock.operators.payload import add_ingestion_metadata, parse
from tallyrock.schema import MICRO_BATCH_INTERVAL, SOURCE_LABEL
from tallyrock.streaming.checkpoints import require_checkpoint
from tallyrock.streaming.metrics import observed

EVERY_INTERVAL = {"processingTime": MICRO_BATCH_INTERVAL}
UNTIL_DRAINED = {"availableNow": True}


def bronze_rows(messages: DataFrame, source: str = SOURCE_LABEL, keep_raw: bool = False) -> DataFrame:
    """One Bronze row per message, also for a message that cannot be parsed."""
    return add_ingestion_metadata(parse(messages, keep_raw=keep_raw), source)


def ingest_bronze(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    source: str = SOURCE_LABEL,
    keep_raw: bool = False,
    trigger: Mapping = EVERY_INTERVAL,
    partition_by: Sequence[str] = ("ingestion_date",),
) -> StreamingQuery:
    """Starts the stream and returns its handle; call awaitTermination to wait.

    Map-only: no shuffle between the source and the files. Bronze is laid out
    by ingestion date, so an incremental reader opens recent days only. Keep
    the checkpoint on durable storage next to the table. What each micro-batch brings is observed as
    it is written; BatchMetrics keeps these figures.
    """
    if fmt == "parquet":
        require_checkpoint(messages.sparkSession, f"{table}/_spark_metadata", checkpoint)
    writer = (
        observed(bronze_rows(messages, source, keep_raw))
        .writeStream.format(fmt)
        .outputMode("append")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    return (writer.partitionBy(*partition_by) if partition_by else writer).start()

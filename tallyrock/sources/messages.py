"""Message streams and JSON-lines folders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrock.schema import BROKERS, TOPIC


def message_stream(
    spark: SparkSession, fmt: str = "kafka", options: Mapping[str, str] | None = None
) -> DataFrame:
    """An unbounded DataFrame with a value column.

    kafka reads topic txn from its earliest offset unless options say otherwise,
    and needs the connector package. Any other format is a file stream; text
    gives the same value column from a folder of JSON lines.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.options(
            **{
                "kafka.bootstrap.servers": BROKERS,
                "subscribe": TOPIC,
                "startingOffsets": "earliest",
            }
        )
    return reader.options(**dict(options or {})).load()


def read_lines(
    spark: SparkSession, folder: str, pattern: str = "*.ndjson", origin: bool = False
) -> DataFrame:
    """Every line of the matching files as value; other files in the folder are left alone.

    Rows come in no promised order. A line is one record, so large files are
    split over tasks. origin adds the file and the block of the file that a line
    was read from.
    """
    lines = spark.read.option("pathGlobFilter", pattern).text(folder)
    if not origin:
        return lines
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )

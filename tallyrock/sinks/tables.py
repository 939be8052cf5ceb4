"""Batch table writers."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from tallyrock.schema import BATCH_COLUMN
from tallyrock.sources.files import move, remove
from tallyrock.sources.tables import read_or_none, read_table


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Adds rows; no key is checked, so a repeated call adds them again."""
    df.write.format(fmt).mode("append").save(path)


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replaces the table. df must not read from path: Spark removes the old files first."""
    df.write.format(fmt).mode("overwrite").save(path)


def replace_batches(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Writes rows under their batch_id, in place of what earlier tries of these batches left.

    Batches that do not occur in df stay as they are, so a repeated or restarted
    batch never doubles rows.
    """
    (
        df.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH_COLUMN)
        .save(path)
    )


def replace_batch(df: DataFrame, path: str, batch_id: str, fmt: str = "parquet") -> None:
    """Writes all rows as one batch. As its id is a constant, no sort by it is needed."""
    replace_batches(df.withColumn(BATCH_COLUMN, F.lit(batch_id)), path, fmt)


def swap_batch(df: DataFrame, path: str, batch_id: str, fmt: str, check: Callable[[], None]) -> None:
    """replace_batch in two steps: the rows are written aside and moved into place once check has passed.

    What a job writes that has lost its turn is so never seen. A batch without rows has no folder.
    """
    spark = df.sparkSession
    aside, place = f"{path}/_aside-{uuid.uuid4().hex}", f"{path}/{BATCH_COLUMN}={batch_id}"
    try:
        counted = Observation()
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.format(fmt).save(aside)
        check()
        remove(spark, place)
        if counted.get["rows"]:
            move(spark, aside, place)
    finally:
        remove(spark, aside)


def mark_path(path: str) -> str:
    return f"{path.rstrip('/')}_mark"


def write_mark(spark: SparkSession, path: str, **values) -> None:
    """One row about the table at path, written when what it speaks of is complete."""
    kinds = {int: "BIGINT", str: "STRING"}
    schema = ", ".join(f"{name} {kinds[type(value)]}" for name, value in values.items())
    row = spark.createDataFrame([tuple(values.values())], schema).coalesce(1)
    row.write.mode("overwrite").parquet(mark_path(path))


def read_written_mark(spark: SparkSession, path: str, schema: str) -> Row | None:
    """That row, or None where there is none, or none that is whole."""
    stored = read_or_none(spark, mark_path(path), "parquet", schema)
    return None if stored is None else stored.first()


@dataclass(frozen=True)
class Report:
    """Rows written and a DataFrame of the first few, both from the written table, and the batch they are in."""

    rows: int
    preview: DataFrame
    batch_id: str | None = None


def report(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: str | None = None,
    batch_id: str | None = None,
    preview_rows: int = 5,
) -> Report:
    """Counts what was written, from file footers, instead of computing it again.

    Of a Parquet table only the folder of the batch is listed. A batch without
    rows has no folder.
    """
    if batch_id is None:
        written = read_table(spark, path, fmt, schema)
    elif fmt == "delta":
        written = read_table(spark, path, fmt).filter(F.col(BATCH_COLUMN) == batch_id)
    else:
        written = read_or_none(spark, f"{path}/{BATCH_COLUMN}={batch_id}", fmt, schema)
    if written is None:
        return Report(0, read_table(spark, path, fmt, schema).limit(0))
    return Report(written.count(), written.limit(preview_rows))

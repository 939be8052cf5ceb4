"""High-water mark and the rows beyond it."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

SLACK_DAYS = 2


def high_water_mark(df: DataFrame, column: str = "ingestion_time") -> DataFrame:
    """One row with the greatest value, NULL for an empty table."""
    return df.agg(F.max(column).alias("high_water_mark"))


def read_mark(df: DataFrame, column: str = "ingestion_time") -> int | None:
    """The mark as microseconds since the epoch: one number comes to the driver.

    A number rather than a Python datetime, which would pass through the
    driver's own time zone.
    """
    return high_water_mark(df, column).select(F.unix_micros("high_water_mark")).first()[0]


def mark_column(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros).cast("bigint"))


def recent_day(mark: int) -> Callable[[str], bool]:
    """Whether a folder of that day, or of no day, can hold rows above the mark."""
    first = (datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=mark)).date()
    limit = (first - datetime.timedelta(days=SLACK_DAYS)).isoformat()
    return lambda day: not day[:1].isdigit() or day >= limit


def new_since(
    df: DataFrame,
    mark: Column | None,
    column: str = "ingestion_time",
    date_column: str | None = None,
) -> DataFrame:
    """Rows strictly above the mark, or all rows when there is none.

    date_column names the partition column that holds the date of column: whole
    days before the mark are then not opened. recent_day says which folders need
    not even be listed. Two days of slack cover any time zone in which the date was taken.
    """
    if mark is None:
        return df
    newer = df.filter(F.col(column) > mark)
    if date_column is None:
        return newer
    day = F.col(date_column)
    return newer.filter((day >= F.date_sub(F.to_date(mark), SLACK_DAYS)) | day.isNull())

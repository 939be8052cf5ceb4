"""Settlement and calendar columns, and text cleaning."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tallyrock.functions import flag, is_high_value, lower_trim, to_time, upper_trim
from tallyrock.schema import (
    HIGH_VALUE_THRESHOLD,
    LOWER_CASE_COLUMNS,
    SETTLED_STATUS,
    UPPER_CASE_COLUMNS,
)


def enrich(
    df: DataFrame,
    high_value_threshold: float = HIGH_VALUE_THRESHOLD,
    time_kind: str = "timestamp",
) -> DataFrame:
    """The seven Silver columns.

    days_to_settle counts calendar days and may be negative. is_settled looks at
    the status as it stands, so on text that is not cleaned yet only the exact
    word counts. time_kind may be timestamp_ntz for data without a time zone.
    """
    timed = df.withColumns(
        {
            "txn_ts": to_time("txn_date", time_kind),
            "settlement_ts": to_time("settlement_date", time_kind),
        }
    )
    return timed.withColumns(
        {
            "txn_date_only": F.to_date("txn_ts"),
            "txn_hour": F.hour("txn_ts"),
            "days_to_settle": F.datediff("settlement_ts", "txn_ts"),
            "is_settled": flag(F.col("txn_status") == SETTLED_STATUS),
            "high_value_flag": flag(is_high_value(threshold=high_value_threshold)),
        }
    )


def normalize(
    df: DataFrame,
    lower: Iterable[str] = LOWER_CASE_COLUMNS,
    upper: Iterable[str] = UPPER_CASE_COLUMNS,
) -> DataFrame:
    """Trimmed text in one case, in place."""
    return df.withColumns(
        {name: lower_trim(name) for name in lower} | {name: upper_trim(name) for name in upper}
    )

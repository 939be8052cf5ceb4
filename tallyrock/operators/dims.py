"""Gold dimensions: distinct natural keys, a missing key kept as a NULL row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyrock.functions import calendar_parts

# Dimension table to its key column in Silver.
KEY_DIMENSIONS = {
    "dim_account": "account_id",
    "dim_customer": "customer_id",
    "dim_transaction_type": "txn_type",
    "dim_channel": "channel",
    "dim_country": "country_code",
    "dim_merchant": "merchant_category",
}


def dim(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def dim_date(df: DataFrame, day: str = "txn_date_only") -> DataFrame:
    """The days that occur, with calendar parts; no days are filled in between."""
    days = df.select(F.col(day).alias("date")).distinct()
    return days.withColumns(calendar_parts("date"))

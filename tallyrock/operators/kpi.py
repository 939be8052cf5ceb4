"""Dashboard measures. All but the fraud measure read Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyrock.functions import average_amount, risk_score, total_amount


def _volume(exact: bool):
    return F.count("*").alias("transactions"), total_amount(exact=exact).alias("amount")


def totals(silver: DataFrame, exact: bool = False) -> DataFrame:
    return silver.agg(
        F.count("*").alias("total_transactions"),
        total_amount(exact=exact).alias("total_amount"),
        average_amount(exact=exact).alias("average_amount"),
    )


def by_status(silver: DataFrame) -> DataFrame:
    return silver.groupBy("txn_status").agg(F.count("*").alias("transactions"))


def settlement_by_status(silver: DataFrame) -> DataFrame:
    return silver.groupBy("txn_status").agg(
        F.count("*").alias("transactions"),
        F.count("settlement_ts").alias("with_settlement"),
        F.avg("days_to_settle").alias("avg_days"),
        F.min("days_to_settle").alias("min_days"),
        F.max("days_to_settle").alias("max_days"),
    )


def settlement_rate(silver: DataFrame) -> DataFrame:
    settled = F.sum("is_settled")
    rate = F.when(F.count("*") > 0, settled / F.count("*"))
    return silver.agg(settled.alias("settled_transactions"), rate.alias("settled_rate"))


def by_fraud_flag(fraud: DataFrame, exact: bool = False) -> DataFrame:
    return fraud.groupBy("fraud_flag").agg(*_volume(exact))


def high_value_volume(silver: DataFrame, exact: bool = False) -> DataFrame:
    return silver.filter(F.col("high_value_flag") == 1).agg(*_volume(exact))


def risk_trend(silver: DataFrame) -> DataFrame:
    """The account risk score month by month."""
    monthly = silver.groupBy("account_id", F.trunc("txn_date_only", "MM").alias("month")).agg(
        F.count("*").alias("txn_count"), F.sum("high_value_flag").alias("high_value_txns")
    )
    return monthly.withColumn("risk_score", risk_score())


def by_channel(silver: DataFrame, exact: bool = False) -> DataFrame:
    return silver.groupBy("channel").agg(*_volume(exact))


def by_merchant(silver: DataFrame, exact: bool = False) -> DataFrame:
    return silver.groupBy("merchant_category").agg(*_volume(exact))

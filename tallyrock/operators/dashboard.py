"""All dashboard measures from one pass over Silver.

One aggregate with a grouping set per measure: a row of Silver is read once, and map tasks reduce it for
all sets before the shuffle. The result is small but for the set of account and month,
so it is written once and every measure is a slice of it. Each slice equals the function of
the same name in `kpi`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallyrock.functions import average_amount, flag, is_suspicious, risk_score, total_amount

SETS = {
    "total": (),
    "status": ("by_status",),
    "channel": ("by_channel",),
    "merchant": ("by_merchant",),
    "fraud": ("by_fraud",),
    "high_value": ("by_high_value",),
    "trend": ("by_account", "by_month"),
    "day": ("by_day",),
}
SET = "grouped_by"


def _keys(fraud_options: dict) -> dict[str, Column]:
    """Grouping column to what it holds. The names are none of Silver's, so measures see the rows as they are."""
    return {
        "by_status": F.col("txn_status"),
        "by_channel": F.col("channel"),
        "by_merchant": F.col("merchant_category"),
        "by_fraud": flag(is_suspicious(**fraud_options)),
        "by_high_value": F.col("high_value_flag"),
        "by_account": F.col("account_id"),
        "by_month": F.trunc("txn_date_only", "MM"),
        "by_day": F.col("txn_date_only"),
    }


def dashboard(silver: DataFrame, exact: bool = False, **fraud_options) -> DataFrame:
    """(grouped_by, the keys, the measures): a row per set and key. fraud_options are those of fraud_fact."""
    keys = _keys(fraud_options)
    rows = silver.select(
        "txn_amount", "settlement_ts", "days_to_settle", "is_settled", "high_value_flag",
        *[column.alias(name) for name, column in keys.items()],
    )
    grouped = rows.groupingSets([[F.col(k) for k in s] for s in SETS.values()], *[F.col(k) for k in keys]).agg(
        F.grouping_id().alias("set_number"),
        F.count("*").alias("transactions"),
        total_amount(exact=exact).alias("amount"),
        average_amount(exact=exact).alias("average"),
        F.count("settlement_ts").alias("with_settlement"),
        F.avg("days_to_settle").alias("avg_days"),
        F.min("days_to_settle").alias("min_days"),
        F.max("days_to_settle").alias("max_days"),
        F.sum("is_settled").alias("settled"),
        F.sum("high_value_flag").alias("high_value_txns"),
    )
    # grouping_id has a bit for each key that is not in the row's set, the first key's the highest.
    names = list(keys)
    numbers = {
        name: sum(1 << (len(names) - 1 - i) for i, key in enumerate(names) if key not in members)
        for name, members in SETS.items()
    }
    label = F.create_map(*[F.lit(x) for name, number in numbers.items() for x in (number, name)])
    return grouped.withColumn(SET, label[F.col("set_number").cast("int")]).drop("set_number")


def _of(table: DataFrame, name: str) -> DataFrame:
    return table.filter(F.col(SET) == name)


def _one(rows: DataFrame, *columns: Column) -> DataFrame:
    """One row, whether there is one in the table or, of an empty Silver, none."""
    return rows.agg(F.coalesce(F.max("transactions"), F.lit(0)).alias("transactions"), *columns)


def totals(table: DataFrame) -> DataFrame:
    one = _one(_of(table, "total"), F.max("amount").alias("total_amount"), F.max("average").alias("average_amount"))
    return one.withColumnRenamed("transactions", "total_transactions")


def by_status(table: DataFrame) -> DataFrame:
    return _of(table, "status").select(F.col("by_status").alias("txn_status"), "transactions")


def settlement_by_status(table: DataFrame) -> DataFrame:
    days = ("with_settlement", "avg_days", "min_days", "max_days")
    return _of(table, "status").select(F.col("by_status").alias("txn_status"), "transactions", *days)


def settlement_rate(table: DataFrame) -> DataFrame:
    one = _one(_of(table, "total"), F.max("settled").alias("settled_transactions"))
    rate = F.when(F.col("transactions") > 0, F.col("settled_transactions") / F.col("transactions"))
    return one.select("settled_transactions", rate.alias("settled_rate"))


def by_fraud_flag(table: DataFrame) -> DataFrame:
    return _of(table, "fraud").select(F.col("by_fraud").alias("fraud_flag"), "transactions", "amount")


def high_value_volume(table: DataFrame) -> DataFrame:
    return _one(_of(table, "high_value").filter("by_high_value = 1"), F.max("amount").alias("amount"))


def risk_trend(table: DataFrame) -> DataFrame:
    return _of(table, "trend").select(
        F.col("by_account").alias("account_id"),
        F.col("by_month").alias("month"),
        F.col("transactions").alias("txn_count"),
        "high_value_txns",
        risk_score(txn_count="transactions").alias("risk_score"),
    )


def daily_summary(table: DataFrame) -> DataFrame:
    return _of(table, "day").select(
        F.col("by_day").alias("txn_date_only"),
        F.col("transactions").alias("total_txns"),
        F.col("amount").alias("total_amount"),
        F.col("average").alias("avg_amount"),
        F.col("settled").alias("settled_txns"),
    )


def by_channel(table: DataFrame) -> DataFrame:
    return _of(table, "channel").select(F.col("by_channel").alias("channel"), "transactions", "amount")


def by_merchant(table: DataFrame) -> DataFrame:
    return _of(table, "merchant").select(F.col("by_merchant").alias("merchant_category"), "transactions", "amount")


MEASURES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "kpi_totals": totals,
    "kpi_status": by_status,
    "kpi_settlement": settlement_by_status,
    "kpi_settlement_rate": settlement_rate,
    "kpi_fraud": by_fraud_flag,
    "kpi_high_value": high_value_volume,
    "kpi_risk_trend": risk_trend,
    "kpi_daily": daily_summary,
    "kpi_channel": by_channel,
    "kpi_merchant": by_merchant,
}

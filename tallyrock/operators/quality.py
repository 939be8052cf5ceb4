"""Acceptance rules for transactions, and reports on them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tallyrock.functions import holds, to_time


def quality_rules(strict_amount: bool = False, strict_dates: bool = False) -> dict[str, Column]:
    """Rule name to the predicate an accepted row satisfies.

    The date rule looks at the text only, so a row whose date cannot be read is
    accepted, and NaN and infinite amounts are above zero. strict_dates and
    strict_amount add rules against these.
    """
    rules = {
        "transaction_id_present": F.col("transaction_id").isNotNull(),
        "account_id_present": F.col("account_id").isNotNull(),
        "customer_id_present": F.col("customer_id").isNotNull(),
        "txn_amount_present": F.col("txn_amount").isNotNull(),
        "txn_amount_positive": F.col("txn_amount") > 0,
        "txn_date_present": F.col("txn_date").isNotNull(),
    }
    if strict_amount:
        rules["txn_amount_finite"] = ~F.isnan("txn_amount") & (F.col("txn_amount") != float("inf"))
    if strict_dates:
        rules["txn_date_readable"] = to_time("txn_date").isNotNull()
    return rules


def _all_of(rules: Mapping[str, Column]) -> Column:
    combined = F.lit(True)
    for predicate in rules.values():
        combined = combined & predicate
    return combined


def accepted(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows that satisfy every rule."""
    return df.filter(_all_of(quality_rules() if rules is None else rules))


def with_reject_reasons(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """All rows with reject_reasons, the names of the rules each one breaks."""
    rules = quality_rules() if rules is None else rules
    broken = [F.when(~holds(predicate), F.lit(name)) for name, predicate in rules.items()]
    return df.withColumn("reject_reasons", F.array_compact(F.array(*broken)))


def split_valid(
    df: DataFrame, rules: Mapping[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with their reasons; together the input."""
    rejected = with_reject_reasons(df, rules).filter(F.size("reject_reasons") > 0)
    return accepted(df, rules), rejected


def quality_report(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """One row: all rows, the rows that break each rule, the accepted rows. One pass."""
    rules = quality_rules() if rules is None else rules
    return df.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(~holds(predicate)).alias(f"failed_{name}") for name, predicate in rules.items()],
        F.count_if(holds(_all_of(rules))).alias("accepted_rows"),
    )


def duplicate_groups(df: DataFrame, keys: tuple[str, ...] = ("transaction_id",)) -> DataFrame:
    """Keys that occur more than once, with their number of rows; missing keys are no duplicates."""
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
    )

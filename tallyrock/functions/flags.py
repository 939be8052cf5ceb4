from pyspark.sql import Column, functions as F

from tallyrock.schema import (
    HIGH_VALUE_THRESHOLD,
    HIGH_VALUE_WEIGHT,
    HOME_COUNTRY,
    NIGHT_HOURS,
    TRANSACTION_WEIGHT,
)


def flag(predicate: Column) -> Column:
    """1 where the predicate holds, 0 where it is false or NULL."""
    return F.when(predicate, 1).otherwise(0)


def holds(predicate: Column) -> Column:
    """The predicate with NULL counted as false."""
    return F.coalesce(predicate, F.lit(False))


def is_high_value(amount="txn_amount", threshold: float = HIGH_VALUE_THRESHOLD) -> Column:
    """Strictly above the threshold; NaN sorts above every number and so counts."""
    return F.col(amount) > F.lit(threshold)


def is_suspicious(
    amount_threshold: float = HIGH_VALUE_THRESHOLD,
    night: tuple[int, int] = NIGHT_HOURS,
    home: str = HOME_COUNTRY,
) -> Column:
    """A large amount, a night hour (both ends included) or a foreign country.

    A missing hour or country does not make a row suspicious; an empty country
    text does, since it differs from the home country.
    """
    return (
        is_high_value(threshold=amount_threshold)
        | F.col("txn_hour").between(*night)
        | (F.col("country_code") != home)
    )


def risk_score(high_value_txns="high_value_txns", txn_count="txn_count") -> Column:
    return F.col(high_value_txns) * F.lit(HIGH_VALUE_WEIGHT) + F.col(txn_count) * F.lit(
        TRANSACTION_WEIGHT
    )

"""Sums and averages of amounts held as doubles.

A sum of doubles depends on the order in which Spark adds them, so two runs may
differ in the last digits. The exact form adds cents as decimals: the same
result in any order, and partial sums can be merged later without a change.
It holds for amounts with at most two decimal places; an amount too large for
the decimal type fails the job instead of being left out, in ANSI mode or not. A group with NaN or
infinite amounts keeps the result of the double sum.
"""

from pyspark.sql import Column, functions as F

CENTS = "decimal(18,2)"


def is_finite(amount: str) -> Column:
    """False for NaN and both infinities, NULL for NULL."""
    return ~F.isnan(amount) & (F.abs(amount) != F.lit(float("inf")))


def cents_of(amount: str) -> Column:
    """The amount as a decimal, NULL for NaN and infinities; one that does not fit fails the job."""
    too_large = F.raise_error(F.concat(F.lit("amount too large for an exact sum: "), F.col(amount).cast("string")))
    cents = F.coalesce(F.col(amount).try_cast(CENTS), too_large.cast(CENTS))
    return F.when(is_finite(amount), cents)


def total_amount(amount="txn_amount", exact: bool = False) -> Column:
    value = F.col(amount)
    if not exact:
        return F.sum(value)
    cents = F.sum(cents_of(amount)).cast("double")
    return F.when(F.bool_and(is_finite(amount)), cents).otherwise(F.sum(value))


def average_amount(amount="txn_amount", exact: bool = False) -> Column:
    if not exact:
        return F.avg(amount)
    filled = F.count(amount)
    return F.when(filled > 0, total_amount(amount, exact=True) / filled)

from pyspark.sql import Column, functions as F


def lower_trim(text) -> Column:
    """Lower case without leading and trailing spaces (spaces only, not tabs)."""
    return F.lower(F.trim(text))


def upper_trim(text) -> Column:
    """Upper case without leading and trailing spaces (spaces only, not tabs)."""
    return F.upper(F.trim(text))

"""The latest row per transaction over all Silver runs, kept up to date by key buckets."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession

from tallyrock.operators.dedup import latest_per_key
from tallyrock.plans.silver import untaken_silver
from tallyrock.schema import SILVER_DDL, SILVER_FIELDS, names
from tallyrock.sinks.buckets import BUCKETS, BucketedTable

KEY = "transaction_id"


def current_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> BucketedTable:
    return BucketedTable(spark, path, [KEY], SILVER_DDL, buckets)


def advance_current(
    spark: SparkSession,
    silver_path: str,
    path: str,
    fmt: str = "parquet",
    buckets: int = BUCKETS,
    tie_breakers: Iterable[Column] | None = None,
    check: Callable[[], None] = lambda: None,
) -> DataFrame:
    """Takes in the Silver batches that the table at path does not have yet, and returns the table.

    Equal to silver_current over all of Silver. What is read and written are the new batches
    and the buckets they have transactions in. A Silver batch holds a transaction once, so a key has no more
    copies than there are new batches, and one shuffle deals them to their buckets.
    """
    breakers = None if tie_breakers is None else list(tie_breakers)
    table = current_table(spark, path, buckets)
    state = table.state()
    new, rows = untaken_silver(spark, silver_path, state.taken, fmt)
    if new:
        state = table.merge(
            state,
            rows.select(*names(SILVER_FIELDS)),
            new,
            prepare=lambda rows: rows,
            combine=lambda rows, keys: latest_per_key(rows, keys, tie_breakers=breakers),
            check=check,
        )
    return table.read(state)

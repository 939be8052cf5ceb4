"""Transactions that come again in a later run, found without reading all of Silver."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrock.operators.key_index import BITS, INDEX_DDL, batches_that_may_hold, key_bitmaps
from tallyrock.schema import BATCH_COLUMN, SILVER_TABLE_DDL
from tallyrock.sinks.tables import replace_batch
from tallyrock.sources.batches import read_batches, read_leaves, stored_batches

KEY = "transaction_id"


@dataclass(frozen=True)
class Repeats:
    """Rows (transaction_id, batch_id of the earlier batch), and the batches that were opened to find them."""

    rows: DataFrame
    opened: list[str]


def index_batch(spark: SparkSession, silver: str, index: str, batch_id: str, fmt: str = "parquet", bits: int = BITS) -> None:
    """Adds a Silver batch to the index, or replaces it there."""
    rows = read_leaves(spark, silver, fmt, SILVER_TABLE_DDL, [batch_id])
    replace_batch(key_bitmaps(rows, KEY, bits), index, batch_id)


def met_again(spark: SparkSession, silver: str, index: str, batch_id: str, fmt: str = "parquet", bits: int = BITS) -> Repeats:
    """The transactions of a batch that batches indexed before hold too, once for each of these.

    bits must be that of the index. At most one name a batch comes to the driver.
    """
    incoming = read_leaves(spark, silver, fmt, SILVER_TABLE_DDL, [batch_id]).select(KEY).distinct()
    known = stored_batches(spark, index)
    candidates = []
    if known:
        bitmaps = read_batches(spark, index, "parquet", f"{INDEX_DDL}, {BATCH_COLUMN} STRING", lambda name: name != batch_id)
        found = batches_that_may_hold(bitmaps, key_bitmaps(incoming, KEY, bits))
        candidates = sorted(r[0] for r in found.collect())
    if not candidates:
        return Repeats(spark.createDataFrame([], f"{KEY} STRING, {BATCH_COLUMN} STRING"), [])
    earlier = read_leaves(spark, silver, fmt, SILVER_TABLE_DDL, candidates).select(KEY, BATCH_COLUMN)
    return Repeats(earlier.join(incoming, KEY, "left_semi").distinct(), candidates)


def record_batch(spark: SparkSession, silver: str, index: str, repeats: str, batch_id: str, fmt: str = "parquet", bits: int = BITS) -> Repeats:
    """Writes what a batch repeats as a batch of the table at repeats, then indexes the batch.

    In this order, so that a run that stopped in between is simply done again.
    """
    found = met_again(spark, silver, index, batch_id, fmt, bits)
    replace_batch(found.rows.withColumnRenamed(BATCH_COLUMN, "earlier_batch"), repeats, batch_id)
    index_batch(spark, silver, index, batch_id, fmt, bits)
    return found


def all_repeats(spark: SparkSession, repeats: str) -> DataFrame:
    """(transaction_id, earlier_batch, batch_id) of all batches recorded."""
    return read_batches(spark, repeats, "parquet", f"{KEY} STRING, earlier_batch STRING, {BATCH_COLUMN} STRING")

"""Which batches may hold a key: a bitmap of key hashes per batch.

A key's hash is a bit of a space of `bits`; Spark keeps 32,768 of them in a bitmap, so a batch has at most
bits / 32,768 rows in the index, of 4 KB each. Two batches share a key only if they share
a bit. A bit shared by chance costs a look into the batch, never a result: what the
index names is compared key by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyrock.schema import BATCH_COLUMN

#: About ten times the keys of a batch, so that a tenth of the foreign keys meet a bit by chance.
BITS = 1 << 22
INDEX_DDL = "part BIGINT, bitmap BINARY"


def key_bitmaps(rows: DataFrame, key: str = "transaction_id", bits: int = BITS, by: tuple[str, ...] = ()) -> DataFrame:
    """(part, bitmap) of the keys of some rows; NULL keys have no bit. Map tasks combine their bits first."""
    place = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    placed = rows.dropna(subset=[key]).select(*by, F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit"))
    return placed.groupBy(*by, "part").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def batches_that_may_hold(index: DataFrame, keys: DataFrame) -> DataFrame:
    """(batch_id): batches of the index that share a bit with the bitmaps of some keys."""
    # Two bitmaps share a bit where together they have fewer than both on their own.
    both = index.withColumnRenamed("bitmap", "own").join(keys, "part")
    stacked = both.select(BATCH_COLUMN, "part", F.explode(F.array("own", "bitmap")).alias("bitmap"))
    united = stacked.groupBy(BATCH_COLUMN, "part").agg(
        F.sum(F.bitmap_count("bitmap")).alias("apart"), F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("together")
    )
    return united.filter("together < apart").select(BATCH_COLUMN).distinct()

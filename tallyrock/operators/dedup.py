"""Latest row per key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyrock.functions import to_time


def default_tie_breakers() -> list[Column]:
    """Source clock, then event id.

    All rows of a micro-batch share one ingestion_time, so copies inside it
    would tie and any of them could win.
    """
    return [to_time("ingest_ts").desc_nulls_last(), F.col("event_id").desc_nulls_last()]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] = ("transaction_id",),
    order: str = "ingestion_time",
    tie_breakers: Iterable[Column] | None = None,
) -> DataFrame:
    """The row with the greatest order value for each key.

    row_number with a filter on 1 lets Spark cut every key to one row per task
    before the shuffle (WindowGroupLimit), so a key with very many copies does
    not gather them all in one task.
    """
    breakers = default_tie_breakers() if tie_breakers is None else list(tie_breakers)
    newest_first = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last(), *breakers)
    return (
        df.withColumn("_position", F.row_number().over(newest_first))
        .filter(F.col("_position") == 1)
        .drop("_position")
    )


PATH, FILE, BLOCK, ROW, WINNERS = "_path", "_file", "_block", "_row", "_winners"
# Rows that one bitmap speaks of: what bitmap_construct_agg holds.
BLOCK_ROWS = 1 << 15
# Rows up to which the bitmaps, a bit per row, are sent to every executor: 256 MB.
PLACED_ROWS = 1 << 31


def latest_stored(
    df: DataFrame,
    keys: Sequence[str] = ("transaction_id",),
    order: str = "ingestion_time",
    tie_breakers: Iterable[Column] | None = None,
) -> DataFrame:
    """latest_per_key of rows as they are read from Parquet files, of which only keys and order are shuffled.

    A row is known by the number of its file and its own number there. latest_per_key finds the winners from the
    keys, the order and that place alone; they go back as bitmaps, one bit per row, by which a second scan picks
    whole rows without a shuffle. df is a scan with filters and projections and nothing else, as only there a
    place is one row, and its files stay as they are. Of more than PLACED_ROWS rows, whose bitmaps would not
    fit, all columns are shuffled.
    """
    breakers = default_tie_breakers() if tie_breakers is None else list(tie_breakers)
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    held = df.select(path.alias(PATH)).groupBy(PATH).count().collect()
    if sum(file["count"] for file in held) > PLACED_ROWS:
        return latest_per_key(df, keys, order, breakers)
    numbers = df.sparkSession.createDataFrame(
        [(file[PATH], number) for number, file in enumerate(held)], f"{PATH} STRING, {FILE} INT"
    )
    places = {PATH: path, BLOCK: F.floor(row / BLOCK_ROWS).cast("int"), ROW: (row % BLOCK_ROWS).cast("int")}
    placed = df.withColumns(places).join(F.broadcast(numbers), PATH)
    winners = latest_per_key(placed, keys, order, breakers).select(FILE, BLOCK, ROW)
    bitmaps = winners.repartition(FILE, BLOCK).groupBy(FILE, BLOCK).agg(F.bitmap_construct_agg(F.col(ROW).cast("bigint")).alias(WINNERS))
    byte = F.substring(F.col(WINNERS), F.floor(F.col(ROW) / 8).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("bigint"), F.col(ROW) % 8)
    return placed.join(F.broadcast(bitmaps), [FILE, BLOCK]).filter(bit == 1).select(*df.columns)

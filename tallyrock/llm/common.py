"""Helpers that several operators share: reading, batches, written intermediates, hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from tallyrock.session import scratch_path

WORD_BREAKS = " \t\n\x0b\x0c\r"  # words are [^\x20\x09-\x0D]+; bytes.split() breaks at the same


def read(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def written(frame: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder, which cuts the lineage and survives lost executors."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def unused(frame: DataFrame, name: str) -> str:
    """A column name like `name` that the frame does not have, in any case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


SPACE = 1 << 25  # bits of `may_be_among`, 4 MB


def with_may_be_among(frame: DataFrame, key: str, wanted: DataFrame, of: str, flag: str) -> DataFrame:
    """The frame with a flag that is true for every row whose key is wanted, and false for most others; no shuffle.

    The wanted keys are bits of a map that is broadcast: SPACE bits at most, whatever their number. So
    where very many keys are wanted, the flag is true for most rows.
    """

    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(SPACE)) + 1

    part, bits, bit = (unused(frame, n) for n in ("bitmap_part", "bitmap_bits", "bitmap_bit"))
    placed = wanted.select(F.bitmap_bucket_number(place(of)).alias(part), F.bitmap_bit_position(place(of)).alias(bit))
    maps = F.broadcast(placed.groupBy(part).agg(F.bitmap_construct_agg(bit).alias(bits)))
    put = frame.withColumns({part: F.bitmap_bucket_number(place(key)), bit: F.bitmap_bit_position(place(key))})
    byte = f"CAST(conv(hex(substring(`{bits}`, CAST(`{bit}` DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    is_set = F.expr(f"coalesce((shiftright({byte}, CAST(`{bit}` % 8 AS INT)) & 1) = 1, false)")
    return put.join(maps, part, "left").withColumn(flag, is_set).drop(part, bits, bit)


def may_be_among(frame: DataFrame, key: str, wanted: DataFrame, of: str) -> DataFrame:
    """Only the rows that `with_may_be_among` flags."""
    flag = unused(frame, "may_be_among")
    return with_may_be_among(frame, key, wanted, of, flag).where(F.col(flag)).drop(flag)


def map_rows(
    frame: DataFrame, work: Callable[[list[list]], list[list]], schema: str, rows: int = 1024
) -> DataFrame:
    """Gives `work` the columns of up to `rows` rows as lists; it returns the result's columns.

    Slices bound the memory of a task whatever the size of Spark's batches.
    """
    fields = _arrow_schema(schema)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, part.num_rows, rows):
                piece = part.slice(start, rows)
                columns = work([column.to_pylist() for column in piece.columns])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, fields)], schema=fields
                )

    return frame.mapInArrow(batches, schema)


def _arrow_schema(schema: str) -> pa.Schema:
    parsed = _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    return to_arrow_schema(parsed)


def crc_mod(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def lower_ascii_words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class Numbered(dict):
    """Remembers what `make` gives for a key; forgets everything when it holds `limit` keys."""

    def __init__(self, make: Callable, limit: int = 400_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def gather(cache: Numbered, keys: list, dtype) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, keys), dtype=dtype, count=len(keys))

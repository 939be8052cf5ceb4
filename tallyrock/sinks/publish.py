"""Keyed messages to a bus or to JSON-lines files."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tallyrock.schema import BROKERS, TOPIC
from tallyrock.sources.tables import read_or_none


@dataclass(frozen=True)
class Progress:
    records: int
    seconds: float

    @property
    def records_per_second(self) -> float:
        return self.records / self.seconds if self.seconds else 0.0


ORDER = "_order_"
SORT_SLICES = 32


def _computed(messages: DataFrame, order: Iterable[str | Column]) -> tuple[DataFrame, list[str]]:
    """The messages with every expression of the order as a column, and the names of the order's columns.

    A sort works out an expression of its order again in every comparison.
    """
    named = [(o, None) if isinstance(o, str) else (f"{ORDER}{i}", o) for i, o in enumerate(order)]
    added = {name: column for name, column in named if column is not None}
    return (messages.withColumns(added) if added else messages), [name for name, _ in named]


def _only_computed(order: Iterable[str]) -> list[str]:
    return [name for name in order if name.startswith(ORDER)]


def in_key_order(messages: DataFrame, *order, partitions: int | None = None) -> DataFrame:
    """Messages ranged by key and then by the order expressions.

    The ranges also split one key with very many messages, at some value of the
    order. Where one message may have very many equal copies, let the order end
    with the file and block it was read from. Part files in name order then hold
    each key's messages in order.
    """
    messages, order = _computed(messages, order)
    bounds = ["key", *order]
    ranged = (
        messages.repartitionByRange(partitions, *bounds)
        if partitions
        else messages.repartitionByRange(*bounds)
    )
    return ranged.sortWithinPartitions(*bounds).drop(*_only_computed(order))


def publish(
    messages: DataFrame,
    fmt: str = "kafka",
    target: str | None = None,
    options: Mapping[str, str] | None = None,
) -> Progress:
    """Sends (key, value) rows and returns how many and how fast.

    kafka writes to topic txn with acks from all replicas unless options say
    otherwise; the key decides the topic's partition. text writes the values as
    lines to the target folder.
    """
    messages = messages.select(*(["value"] if fmt == "text" else ["key", "value"]))
    counted = Observation("published")
    writer = messages.observe(counted, F.count(F.lit(1)).alias("records")).write.format(fmt)
    if fmt == "kafka":
        writer = writer.options(
            **{"kafka.bootstrap.servers": BROKERS, "topic": TOPIC, "kafka.acks": "all"}
        )
    else:
        writer = writer.mode("append")
    writer = writer.options(**dict(options or {}))
    started = time.monotonic()
    writer.save(target) if target else writer.save()
    return Progress(counted.get["records"], time.monotonic() - started)


def dealt_by_key(messages: DataFrame, partitions: int, *order) -> DataFrame:
    """Messages dealt by key to as many tasks as the bus has partitions, in order within each.

    All messages of a key are in one task and leave it one after the other, so its order holds on the
    bus. A task sorts its messages in SORT_SLICES parts, one after the other, each with all messages of
    its keys, so what it sorts at a time fits in memory. One account with very many messages is inherently
    sequential: its task sorts on disk and sends alone. Messages without a key have no order to keep and are
    spread by their text.
    """
    dealt = messages.repartition(partitions * SORT_SLICES, F.coalesce("key", "value"))
    dealt, order = _computed(dealt, order)
    return dealt.sortWithinPartitions("key", *order).drop(*_only_computed(order)).coalesce(partitions)


class Sender(Protocol):
    """Where the messages of one partition go. send must keep their order."""

    def send(self, key: str | None, value: str) -> None: ...

    def close(self) -> None: ...


def send_partitions(messages: DataFrame, open_sender: Callable[[int], Sender]) -> Progress:
    """Sends every partition through a sender of its own, which the task opens with the partition's number.

    A task that Spark repeats sends its partition again from the start, in order: consumers see each message at
    least once. Keep speculation off.
    """

    def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender, sent = open_sender(TaskContext.get().partitionId()), 0
        try:
            for part in parts:
                for key, value in zip(*(column.to_pylist() for column in part.columns)):
                    sender.send(key, value)
                    sent += 1
        finally:
            sender.close()
        yield pa.RecordBatch.from_arrays([pa.array([sent], pa.int64())], ["records"])

    started = time.monotonic()
    counts = messages.select("key", "value").mapInArrow(send, "records BIGINT")
    records = counts.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
    return Progress(records, time.monotonic() - started)


class StreamMeter:
    """Counts what a stream adds to its table, over any number of micro-batches.

    A query's own list of progress has its last micro-batches only. Rows are counted from the
    table's file footers: make the meter before the stream starts.
    """

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None):
        self.spark, self.path, self.fmt, self.schema = spark, path, fmt, schema
        self.before, self.started = self._rows(), time.monotonic()

    def _rows(self) -> int:
        table = read_or_none(self.spark, self.path, self.fmt, self.schema)
        return 0 if table is None else table.count()

    def progress(self) -> Progress:
        return Progress(self._rows() - self.before, time.monotonic() - self.started)

"""Bronze to Silver."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F

from tallyrock.operators.dedup import latest_per_key, latest_stored
from tallyrock.operators.enrich import enrich, normalize
from tallyrock.operators.incremental import mark_column, new_since, read_mark, recent_day
from tallyrock.operators.quality import accepted, quality_rules
from tallyrock.plans.lease import Lease, lease
from tallyrock.schema import (
    BATCH_COLUMN,
    BRONZE_DDL,
    BRONZE_FIELDS,
    HIGH_VALUE_THRESHOLD,
    SILVER_DDL,
    SILVER_FIELDS,
    SILVER_TABLE_DDL,
    names,
)
from tallyrock.sinks.tables import Report, read_written_mark, replace_batch, report, swap_batch, write_mark
from tallyrock.sinks.validated import ACCEPTED, read_validated, write_validated
from tallyrock.sources.batches import FANOUT, batch_of, compact, covering, leaves_of, read_batches, stored_batches
from tallyrock.sources.files import Journal
from tallyrock.sources.tables import folder_names, read_folders, read_or_none, read_table


def silver_increment(
    bronze: DataFrame,
    mark: Column | None = None,
    *,
    date_column: str | None = None,
    high_value_threshold: float = HIGH_VALUE_THRESHOLD,
    time_kind: str = "timestamp",
    normalize_first: bool = False,
    strict_amount: bool = False,
    strict_dates: bool = False,
    tie_breakers: Iterable[Column] | None = None,
    stored: bool = False,
) -> DataFrame:
    """Silver rows for the Bronze rows above the mark.

    Flags are set before the text is cleaned, so a padded status is not settled;
    normalize_first cleans first. Duplicates are removed within the increment;
    see silver_current for the whole table. That comes before the new columns,
    which depend on one row only: the shuffle carries Bronze columns, and rows
    that lose are not worked on. tie_breakers are expressions on Bronze columns. stored says that bronze is
    a Parquet table as read, of which the shuffle carries keys and order only.
    """
    rows = new_since(bronze, mark, date_column=date_column)
    rows = accepted(rows, quality_rules(strict_amount, strict_dates))
    return cleaned(rows, high_value_threshold, time_kind, normalize_first, tie_breakers, stored)


def cleaned(
    rows: DataFrame,
    high_value_threshold: float = HIGH_VALUE_THRESHOLD,
    time_kind: str = "timestamp",
    normalize_first: bool = False,
    tie_breakers: Iterable[Column] | None = None,
    stored: bool = False,
) -> DataFrame:
    """Silver rows for accepted Bronze rows."""
    rows = (latest_stored if stored else latest_per_key)(rows, tie_breakers=tie_breakers)
    if normalize_first:
        rows = enrich(normalize(rows), high_value_threshold, time_kind)
    else:
        rows = normalize(enrich(rows, high_value_threshold, time_kind))
    return rows.select(*names(SILVER_FIELDS))


def silver_current(
    silver: DataFrame, tie_breakers: Iterable[Column] | None = None, stored: bool = False
) -> DataFrame:
    """The latest row per transaction over all increments; stored as for silver_increment."""
    return (latest_stored if stored else latest_per_key)(silver, tie_breakers=tie_breakers)


# A batch is named after the mark it starts from, in microseconds.
BATCH_PREFIX = "from-"


def _batch_name(micros: int | None) -> str:
    return f"{BATCH_PREFIX}{'start' if micros is None else micros}"


def batches_since(micros: int) -> Column:
    """True for the batches that can hold rows above a mark Silver once had.

    Runs follow each other, so such a batch starts from that mark or a later
    one. Batches with other names, such as a stream's, stay in.
    """
    batch = F.col(BATCH_COLUMN)
    start = F.substring(batch, len(BATCH_PREFIX) + 1, 20).try_cast("bigint")
    return ~batch.startswith(BATCH_PREFIX) | (start >= micros)


def read_silver(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All of Silver, whether its batches have been merged or not."""
    return read_batches(spark, path, fmt, SILVER_TABLE_DDL)


def read_silver_since(spark: SparkSession, path: str, micros: int | None, fmt: str = "parquet") -> DataFrame:
    """The Silver batches that can hold rows above a mark, or all without one; other folders are not listed."""
    if micros is None:
        return read_silver(spark, path, fmt)

    def wanted(name: str) -> bool:
        batch = batch_of(name)
        if batch is None or batch.kind != "from":
            return True
        return batch.start >= micros if batch.end is None else batch.end > micros

    return read_batches(spark, path, fmt, SILVER_TABLE_DDL, wanted).filter(batches_since(micros))


def complete_batches(spark: SparkSession, path: str, noted: Row | None) -> Callable[[str], bool]:
    """Which batches may be taken for good: those whose run has ended.

    A run notes its mark after its batch is whole, and a mark lies above the start of its batch. A
    stream notes the number of the batch it has written. Tables without such a note have been written otherwise, whole.
    """
    streamed = Journal(spark, stream_notes(path)).last()[1]

    def complete(name: str) -> bool:
        batch = batch_of(name)
        if batch is None or batch.end is not None:
            return True
        if batch.kind == "stream":
            return streamed is None or batch.start <= streamed["batch"]
        return noted is None or batch.start < noted["mark"]

    return complete


def stream_notes(path: str) -> str:
    return f"{path.rstrip('/')}_stream"


def untaken_silver(spark: SparkSession, path: str, taken: Collection[str], fmt: str = "parquet") -> tuple[list[str], DataFrame]:
    """The batches that are not among those taken, and their rows, whatever their ingestion times.

    The list of batches comes from folder names; only folders with a new batch are opened. A table
    without batch folders counts as new as long as nothing has been taken.
    """
    names_of = None if fmt == "delta" else stored_batches(spark, path)
    if names_of is None:
        raise ValueError(f"{path} has no batch folders to keep account of: use a full refresh")
    complete = complete_batches(spark, path, read_written_mark(spark, path, "mark BIGINT"))
    held = {name: leaves_of(spark, path, name) for name in covering(names_of) if complete(name)}
    new = sorted(leaf for leaves in held.values() for leaf in leaves if leaf not in taken)
    if not new:
        return [], spark.createDataFrame([], SILVER_TABLE_DDL)
    folders = {name for name, leaves in held.items() if not set(leaves) <= set(taken)}
    rows = read_batches(spark, path, fmt, SILVER_TABLE_DDL, folders.__contains__)
    old = sorted(leaf for name in folders for leaf in held[name] if leaf in taken)
    return new, rows.filter(~F.col(BATCH_COLUMN).isin(old)) if old else rows


def compact_silver(spark: SparkSession, path: str, fmt: str = "parquet", fanout: int = FANOUT, wait: float = 0.0) -> int:
    """Merges Silver's older batches level by level, while no run works on it; returns the number of merges."""
    with lease(spark, path, wait=wait) as turn:
        return compact(spark, path, SILVER_DDL, fmt, fanout, turn.check)


def silver_mark(spark: SparkSession, path: str, fmt: str = "parquet") -> int | None:
    """The greatest ingestion time in Silver: from the newest batch beyond the one a run has noted.

    Every run notes the mark it reached. Only batches from there on are read, so the cost is that of
    an increment; without a note, of a table that a stream wrote, all of Silver is.
    """
    noted = read_written_mark(spark, path, "mark BIGINT")
    known = None if noted is None else noted["mark"]
    if folder_names(spark, path) is None and fmt != "delta":
        return None
    silver = read_or_none(spark, path, fmt, SILVER_TABLE_DDL) if known is None else read_silver_since(spark, path, known, fmt)
    found = None if silver is None else read_mark(silver)
    return max((m for m in (known, found) if m is not None), default=None)


def run_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    fmt: str = "parquet",
    date_column: str | None = "ingestion_date",
    *,
    validated_path: str | None = None,
    turn: Lease | None = None,
    strict_amount: bool = False,
    strict_dates: bool = False,
    **options,
) -> Report:
    """One incremental run, from the mark in Silver to the end of Bronze.

    The batch is named after the mark it starts from. A run that stopped half
    way leaves the mark as it was, so the next one writes the same batch again,
    in its place. date_column is Bronze's partition column, None if it has none. Of Bronze, the
    folders of recent days are listed, of Silver the newest batch.

    validated_path keeps the verdict on every row read, as a batch of the same name; Bronze is
    then read once, and Silver made from the rows that were accepted there. The mark is then that of all
    rows read, so that each is judged in one run. With a turn, from `lease`, the run
    checks that it still has it before its batch, and again before its mark, becomes visible.
    """
    micros = silver_mark(spark, silver_path, fmt)
    if micros is None or date_column is None:
        bronze = read_table(spark, bronze_path, fmt, BRONZE_DDL)
    else:
        bronze = read_folders(spark, bronze_path, date_column, recent_day(micros), fmt, BRONZE_DDL)
    mark, batch_id = None if micros is None else mark_column(micros), _batch_name(micros)
    # The mark comes out of the write itself: what was written is not read back for it.
    seen = Observation("increment")
    newest = F.max(F.unix_micros(F.col("ingestion_time").cast("timestamp"))).alias("reached")
    if validated_path is None:
        rules = {"strict_amount": strict_amount, "strict_dates": strict_dates, "stored": fmt == "parquet"}
        increment = silver_increment(bronze, mark, date_column=date_column, **rules, **options).observe(seen, newest)
    else:
        new = new_since(bronze, mark, date_column=date_column).select(*names(BRONZE_FIELDS)).observe(seen, newest)
        write_validated(new, validated_path, batch_id, quality_rules(strict_amount, strict_dates), fmt)
        judged = read_validated(spark, validated_path, ACCEPTED, batch_id, fmt)
        increment = cleaned(judged.select(*names(BRONZE_FIELDS)), **options)
    if turn is None or fmt == "delta":
        replace_batch(increment, silver_path, batch_id, fmt)
    else:
        swap_batch(increment, silver_path, batch_id, fmt, turn.check)
    reached = seen.get["reached"]
    if turn is not None:
        turn.check()
    if fmt != "delta" and reached is not None:
        write_mark(spark, silver_path, mark=reached)
    return replace(report(spark, silver_path, fmt, SILVER_DDL, batch_id), batch_id=batch_id)

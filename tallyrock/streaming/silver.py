"""Bronze to Silver as a stream over the Bronze table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyrock.plans.silver import silver_increment, stream_notes
from tallyrock.schema import BRONZE_DDL
from tallyrock.sinks.tables import replace_batch
from tallyrock.sources.files import Journal
from tallyrock.streaming.bronze import EVERY_INTERVAL
from tallyrock.streaming.checkpoints import require_checkpoint


def stream_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    trigger: Mapping = EVERY_INTERVAL,
    source_options: Mapping[str, str] | None = None,
    **options,
) -> StreamingQuery:
    """Silver without a high-water mark: the checkpoint knows which Bronze files are done.

    No row is skipped when a clock steps back, and finding new files does not
    mean listing the table. Each micro-batch is one increment under its own
    batch id, so a batch that Spark repeats after a failure replaces itself.
    """
    require_checkpoint(spark, silver_path, checkpoint)
    reader = spark.readStream.format(fmt).options(**dict(source_options or {}))
    if fmt != "delta":
        reader = reader.schema(BRONZE_DDL)

    def write(batch: DataFrame, number: int) -> None:
        replace_batch(silver_increment(batch, **options), silver_path, f"stream-{number}", fmt)
        journal = Journal(spark, stream_notes(silver_path))
        last, note = journal.last()
        if note is None or note["batch"] < number:
            journal.add(last, {"batch": number})

    return (
        reader.load(bronze_path)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )

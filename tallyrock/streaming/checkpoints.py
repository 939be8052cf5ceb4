from __future__ import annotations

from pyspark.sql import SparkSession

from tallyrock.sources.tables import path_exists


class LostCheckpoint(RuntimeError):
    """A stream would restart from the beginning on a table it has already written."""


def require_checkpoint(spark: SparkSession, written: str, checkpoint: str) -> None:
    """Stops when the stream's output is there but its checkpoint is not.

    A new checkpoint numbers its batches from zero again. The file sink skips
    the numbers it has seen, and a batch-keyed table would replace the old
    batches, so either way rows would be lost.
    """
    if not path_exists(spark, f"{checkpoint}/metadata") and path_exists(spark, written):
        raise LostCheckpoint(
            f"{written} exists but {checkpoint} holds no checkpoint: restore it or use a new table"
        )

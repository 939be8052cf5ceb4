"""Figures of a stream's micro-batches, kept as a table while it runs."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tallyrock.sources.files import create_once, exists, names_in, read_text, remove

OBSERVED = "micro_batch"
METRICS_DDL = (
    "query STRING, run STRING, batch BIGINT, started STRING, input_rows BIGINT, records BIGINT,"
    " without_id BIGINT, seconds DOUBLE"
)
FOLD = 512  # files of one batch each that are put together


def observed(rows: DataFrame, key: str = "transaction_id") -> DataFrame:
    """The same rows; a micro-batch of them reports how many there were and how many without the key."""
    return rows.observe(
        OBSERVED, F.count(F.lit(1)).alias("records"), F.count_if(F.col(key).isNull()).alias("without_id")
    )


class BatchMetrics(StreamingQueryListener):
    """Writes one line per micro-batch of the session's streams to a folder as soon as it has ended.

    Add it to spark.streams before the stream starts. Every FOLD lines of a run are put into one
    file. A line that is met twice, because the listener stopped while folding, counts
    once. The listener sees what is reported from its adding on; figures of earlier runs stay.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.running = threading.Condition()
        self.started, self.ended = 0, 0

    def onQueryStarted(self, event) -> None:
        with self.running:
            self.started += 1

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        figures = progress.observedMetrics.get(OBSERVED)
        if figures is None:  # a stream of another kind
            return
        line = {
            "query": str(progress.id),
            "run": str(progress.runId),
            "batch": progress.batchId,
            "started": progress.timestamp,
            "input_rows": progress.numInputRows,
            "records": figures["records"],
            "without_id": figures["without_id"],
            "seconds": progress.batchDuration / 1000,
        }
        create_once(self.spark, f"{self.path}/{progress.runId}-{progress.batchId:012}.json", json.dumps(line) + "\n")
        if progress.batchId % FOLD == FOLD - 1:
            self.fold(str(progress.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.running:
            self.ended += 1
            self.running.notify_all()

    def wait(self, seconds: float = 60.0) -> bool:
        """Until the end of every stream seen so far has been reported; False after that many seconds."""
        with self.running:
            return self.running.wait_for(lambda: 0 < self.started <= self.ended, seconds)

    def fold(self, run: str) -> None:
        """Puts the lines of single batches of a run into one file, then removes theirs."""
        single = [n for n in names_in(self.spark, self.path) if n.startswith(f"{run}-") and n.endswith(".json")]
        if len(single) < 2:
            return
        folded = f"{self.path}/to-{single[-1]}"
        if not exists(self.spark, folded):
            create_once(self.spark, folded, "".join(read_text(self.spark, f"{self.path}/{n}") for n in single))
        for name in single:
            remove(self.spark, f"{self.path}/{name}")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """A row per micro-batch."""
    return spark.read.schema(METRICS_DDL).json(path).dropDuplicates(["run", "batch"])

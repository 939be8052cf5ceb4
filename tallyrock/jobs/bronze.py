"""Message stream to Bronze."""

from __future__ import annotations

from tallyrock.jobs.options import BRONZE_CHECKPOINT, add_stream, pairs, parser, trigger
from tallyrock.session import job_session
from tallyrock.sources.messages import message_stream
from tallyrock.streaming.bronze import ingest_bronze
from tallyrock.streaming.metrics import BatchMetrics


def main(arguments: list[str] | None = None) -> None:
    options = parser(__doc__, "bronze")
    add_stream(options, BRONZE_CHECKPOINT)
    options.add_argument("--source", default="kafka", help="kafka, or text for a folder of JSON lines")
    options.add_argument("--keep-raw", action="store_true", help="add the message text as raw_value")
    options.add_argument("--metrics", help="folder that keeps the figures of every micro-batch; none by default")
    chosen = options.parse_args(arguments)
    spark = job_session("transactions to Bronze")
    metrics = BatchMetrics(spark, chosen.metrics) if chosen.metrics else None
    if metrics is not None:
        spark.streams.addListener(metrics)
    query = ingest_bronze(
        message_stream(spark, chosen.source, pairs(chosen.option)),
        chosen.bronze,
        chosen.checkpoint,
        fmt=chosen.format,
        keep_raw=chosen.keep_raw,
        trigger=trigger(chosen),
    )
    query.awaitTermination()
    if metrics is not None:
        metrics.wait()
        spark.streams.removeListener(metrics)


if __name__ == "__main__":
    main()

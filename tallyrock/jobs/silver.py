"""Bronze to Silver: one incremental run, or a stream over Bronze."""

from __future__ import annotations

from tallyrock.jobs.options import (
    SILVER_CHECKPOINT,
    add_silver,
    add_threshold,
    add_stream,
    add_wait,
    pairs,
    parser,
    silver_options,
    trigger,
)
from tallyrock.plans.lease import lease
from tallyrock.plans.silver import run_silver
from tallyrock.session import job_session
from tallyrock.streaming.silver import stream_silver


def main(arguments: list[str] | None = None) -> None:
    options = parser(__doc__, "bronze", "silver")
    add_threshold(options)
    add_silver(options)
    add_stream(options, SILVER_CHECKPOINT)
    add_wait(options)
    options.add_argument("--stream", action="store_true", help="follow Bronze by checkpoint")
    chosen = options.parse_args(arguments)
    if chosen.stream and chosen.validated:
        options.error("--validated keeps the verdicts of runs, not of a stream")
    spark = job_session("transactions to Silver")
    if chosen.stream:
        stream_silver(
            spark,
            chosen.bronze,
            chosen.silver,
            chosen.checkpoint,
            fmt=chosen.format,
            trigger=trigger(chosen),
            source_options=pairs(chosen.option),
            **silver_options(chosen),
        ).awaitTermination()
        return
    with lease(spark, chosen.silver, wait=chosen.wait) as turn:
        written = run_silver(
            spark, chosen.bronze, chosen.silver, chosen.format,
            validated_path=chosen.validated, turn=turn, **silver_options(chosen),
        )
    print(f"{written.rows:,} Silver rows added")
    written.preview.show(truncate=False)


if __name__ == "__main__":
    main()

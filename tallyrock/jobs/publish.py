"""JSON-lines folder to keyed messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyrock.jobs.options import RAW, pairs, parser
from tallyrock.operators.payload import lines_to_messages
from tallyrock.session import job_session
from tallyrock.sinks.publish import dealt_by_key, in_key_order, publish
from tallyrock.sources.messages import read_lines


def main(arguments: list[str] | None = None) -> None:
    options = parser(__doc__)
    options.set_defaults(format="kafka")
    options.add_argument("--lines", default=RAW, help="folder of *.ndjson files")
    options.add_argument("--target", help="folder, for the text format")
    options.add_argument("--option", action="append", default=[], help="sink option as name=value")
    options.add_argument(
        "--ordered-by", help="payload field by which each account's messages are written in order"
    )
    options.add_argument(
        "--partitions", type=int, help="partitions of the topic: with --ordered-by, one task sends all of an account"
    )
    chosen = options.parse_args(arguments)
    if chosen.ordered_by and chosen.format != "text" and not chosen.partitions:
        # Ranges of one account would be sent by several tasks at the same time.
        options.error("--ordered-by on a bus needs the topic's number of --partitions")
    spark = job_session("publish transactions")
    messages = lines_to_messages(read_lines(spark, chosen.lines, origin=True), strict=True)
    if chosen.ordered_by:
        name = chosen.ordered_by
        field = F.from_json("value", f"`{name}` STRING").getField(name)
        order = [field, "file", "block", "value"]
        if chosen.partitions:
            messages = dealt_by_key(messages, chosen.partitions, *order)
        else:
            messages = in_key_order(messages, *order)
    progress = publish(messages, chosen.format, chosen.target, pairs(chosen.option))
    print(f"{progress.records:,} records, {progress.records_per_second:.2f} per second")


if __name__ == "__main__":
    main()

"""Silver to Gold and its CSV extracts."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from tallyrock.jobs.options import add_gold, add_threshold, add_wait, fraud_options, parser
from tallyrock.plans.gold import refresh_gold
from tallyrock.plans.gold_increment import refresh_gold_increment
from tallyrock.plans.lease import lease
from tallyrock.session import job_session


def refresh_of(chosen: argparse.Namespace) -> tuple[Callable, dict]:
    """The refresh that the options name, and its keyword arguments."""
    shared = {
        "exact": chosen.exact,
        "fraud_options": fraud_options(chosen),
        "single_file": chosen.single_file,
        "buckets": chosen.buckets,
    }
    if not chosen.incremental:
        return refresh_gold, shared | {"dedup": chosen.dedup}
    if chosen.dedup != "run":
        raise SystemExit("--incremental counts every Silver row: use it with --dedup run")
    return refresh_gold_increment, shared


def main(arguments: list[str] | None = None) -> None:
    options = parser(__doc__, "silver", "gold", "csv")
    add_threshold(options)
    add_gold(options)
    add_wait(options)
    chosen = options.parse_args(arguments)
    refresh, more = refresh_of(chosen)
    spark = job_session("transactions to Gold")
    csv = None if chosen.no_csv else chosen.csv
    with lease(spark, chosen.gold, wait=chosen.wait):
        tables = refresh(spark, chosen.silver, chosen.gold, csv, fmt=chosen.format, **more)
    tables["gold_transaction_lifecycle"].show(5, truncate=False)


if __name__ == "__main__":
    main()

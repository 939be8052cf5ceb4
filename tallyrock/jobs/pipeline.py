"""One Silver run, then one Gold refresh; for a scheduler to call."""

from __future__ import annotations

from tallyrock.jobs.gold import refresh_of
from tallyrock.jobs.options import add_gold, add_silver, add_threshold, add_wait, parser, silver_options
from tallyrock.plans.pipeline import run_pipeline
from tallyrock.session import job_session


def main(arguments: list[str] | None = None) -> None:
    options = parser(__doc__, "bronze", "silver", "gold", "csv")
    add_threshold(options)
    add_silver(options)
    add_gold(options)
    add_wait(options)
    chosen = options.parse_args(arguments)
    refresh, gold_options = refresh_of(chosen)
    tables = run_pipeline(
        job_session("transactions to Silver and Gold"),
        chosen.bronze,
        chosen.silver,
        chosen.gold,
        None if chosen.no_csv else chosen.csv,
        fmt=chosen.format,
        silver_options=silver_options(chosen) | {"validated_path": chosen.validated},
        gold_options=gold_options,
        refresh=refresh,
        wait=chosen.wait,
        after_silver=lambda written: print(f"{written.rows:,} Silver rows added"),
    )
    tables["gold_transaction_lifecycle"].show(5, truncate=False)


if __name__ == "__main__":
    main()

"""Merges Silver's older batches level by level; for a scheduler to call now and then."""

from __future__ import annotations

from tallyrock.jobs.options import add_wait, parser
from tallyrock.plans.silver import compact_silver
from tallyrock.session import job_session
from tallyrock.sources.batches import FANOUT


def main(arguments: list[str] | None = None) -> None:
    options = parser(__doc__, "silver")
    options.add_argument("--fanout", type=int, default=FANOUT, help="neighbouring folders that become one")
    add_wait(options)
    chosen = options.parse_args(arguments)
    spark = job_session("compact Silver")
    print(f"{compact_silver(spark, chosen.silver, chosen.format, chosen.fanout, chosen.wait)} merges")


if __name__ == "__main__":
    main()

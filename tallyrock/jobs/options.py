from __future__ import annotations

import argparse

from tallyrock.schema import HIGH_VALUE_THRESHOLD, HOME_COUNTRY, MICRO_BATCH_INTERVAL, NIGHT_HOURS
from tallyrock.sinks.buckets import BUCKETS

# Where the layers live unless an option says otherwise.
RAW = "/data/raw"
BRONZE = "/data/bronze/transactions"
SILVER = "/data/silver/transactions"
GOLD = "/data/gold"
CSV = "/data/bi"
BRONZE_CHECKPOINT = "/data/checkpoints/bronze/transactions"
SILVER_CHECKPOINT = "/data/checkpoints/silver/transactions"

LAYERS = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD, "csv": CSV}


def parser(description: str, *layers: str) -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(description=description)
    options.add_argument("--format", default="parquet", help="table format, such as parquet or delta")
    for layer in layers:
        options.add_argument(f"--{layer}", default=LAYERS[layer], help=f"default {LAYERS[layer]}")
    return options


def add_stream(options: argparse.ArgumentParser, checkpoint: str) -> None:
    options.add_argument("--checkpoint", default=checkpoint, help=f"default {checkpoint}")
    options.add_argument("--option", action="append", default=[], help="source option as name=value")
    options.add_argument("--interval", default=MICRO_BATCH_INTERVAL, help="time between micro-batches")
    options.add_argument(
        "--drain", action="store_true", help="process what is there and end, instead of running on"
    )


def add_threshold(options: argparse.ArgumentParser) -> None:
    options.add_argument(
        "--high-value",
        type=float,
        default=HIGH_VALUE_THRESHOLD,
        help="amount above which Silver's flag is set and Gold's fraud rule applies",
    )


def add_silver(options: argparse.ArgumentParser) -> None:
    options.add_argument("--normalize-first", action="store_true")
    options.add_argument("--strict-amount", action="store_true")
    options.add_argument("--strict-dates", action="store_true")
    options.add_argument("--validated", help="table that keeps every row read with its verdict; none by default")


def add_wait(options: argparse.ArgumentParser) -> None:
    options.add_argument(
        "--wait", type=float, default=0.0, help="seconds to wait for a job that works on the same tables; then fail"
    )


def add_gold(options: argparse.ArgumentParser) -> None:
    options.add_argument("--no-csv", action="store_true", help="leave out the CSV extracts")
    options.add_argument("--single-file", action="store_true", help="one CSV part file per dataset")
    options.add_argument(
        "--night", type=int, nargs=2, default=NIGHT_HOURS, metavar="HOUR", help="first and last hour of the fraud rule"
    )
    options.add_argument("--home", default=HOME_COUNTRY, help="country that the fraud rule does not flag")
    options.add_argument("--exact", action="store_true", help="sums that do not depend on row order")
    options.add_argument("--dedup", choices=("run", "table"), default="run")
    options.add_argument(
        "--incremental", action="store_true", help="add new Silver batches to running totals"
    )
    options.add_argument(
        "--buckets", type=int, default=BUCKETS, help="key buckets of new tables that --incremental or --dedup table keeps"
    )


def trigger(chosen: argparse.Namespace) -> dict:
    return {"availableNow": True} if chosen.drain else {"processingTime": chosen.interval}


def silver_options(chosen: argparse.Namespace) -> dict:
    return {
        "high_value_threshold": chosen.high_value,
        "normalize_first": chosen.normalize_first,
        "strict_amount": chosen.strict_amount,
        "strict_dates": chosen.strict_dates,
    }


def fraud_options(chosen: argparse.Namespace) -> dict:
    return {"amount_threshold": chosen.high_value, "night": tuple(chosen.night), "home": chosen.home}


def pairs(texts: list[str]) -> dict[str, str]:
    return dict(text.split("=", 1) for text in texts)

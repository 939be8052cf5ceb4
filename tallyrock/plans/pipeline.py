"""Silver, then Gold."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession

from tallyrock.plans.gold import refresh_gold
from tallyrock.plans.lease import lease
from tallyrock.plans.silver import run_silver
from tallyrock.sinks.tables import Report


def run_pipeline(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    gold_path: str,
    csv_path: str | None = None,
    *,
    fmt: str = "parquet",
    silver_options: dict | None = None,
    gold_options: dict | None = None,
    refresh: Callable[..., dict[str, DataFrame]] = refresh_gold,
    after_silver: Callable[[Report], None] = lambda report: None,
    wait: float | None = None,
) -> dict[str, DataFrame]:
    """One incremental Silver run and, only if it succeeds, one Gold refresh.

    A repeated call on the same Bronze adds nothing. When to call it is up to
    the caller. With `wait` it takes its turn on the Silver table: a call that overlaps another waits so
    many seconds for it to end and is then refused. Without, calls must not overlap. refresh may be
    refresh_gold_increment; after_silver gets the report of the Silver run.
    """
    with nullcontext() if wait is None else lease(spark, silver_path, wait=wait) as turn:
        options = dict(silver_options or {}) | {"turn": turn}
        after_silver(run_silver(spark, bronze_path, silver_path, fmt, **options))
        if turn is not None:
            turn.check()
        return refresh(spark, silver_path, gold_path, csv_path, fmt=fmt, **(gold_options or {}))

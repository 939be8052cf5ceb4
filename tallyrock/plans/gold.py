"""Silver to Gold."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession

from tallyrock.operators.dims import KEY_DIMENSIONS, dim, dim_date
from tallyrock.operators.facts import credit_risk_fact, daily_summary, fraud_fact, lifecycle_fact
from tallyrock.plans.current import advance_current
from tallyrock.plans.side_by_side import run_all
from tallyrock.plans.silver import read_silver, silver_current
from tallyrock.sinks.buckets import BUCKETS
from tallyrock.sinks.csv import export_csv
from tallyrock.sinks.tables import overwrite_table
from tallyrock.sources.tables import read_table, schema_of

# The names of the eleven tables.
FACTS = (
    "gold_transaction_lifecycle",
    "gold_fraud_detection",
    "gold_credit_risk",
    "gold_transaction_summary",
)
GOLD_TABLES = (*FACTS, "dim_date", *KEY_DIMENSIONS)

# Dimensions that a small set of attribute combinations can answer together.
ATTRIBUTE_DIMENSIONS = ("dim_transaction_type", "dim_channel", "dim_country", "dim_merchant")


def gold_tables(
    silver: DataFrame, exact: bool = False, fraud_options: Mapping | None = None
) -> dict[str, DataFrame]:
    """Every Gold table as a plan on Silver; fraud_options are those of fraud_fact."""
    tables = {
        "gold_transaction_lifecycle": lifecycle_fact(silver),
        "gold_fraud_detection": fraud_fact(silver, **dict(fraud_options or {})),
        "gold_credit_risk": credit_risk_fact(silver, exact),
        "gold_transaction_summary": daily_summary(silver, exact),
        "dim_date": dim_date(silver),
    }
    return tables | {name: dim(silver, key) for name, key in KEY_DIMENSIONS.items()}


def export_all(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    csv_path: str,
    single_file: bool = False,
    at_once: int = 4,
    compression: str = "none",
) -> None:
    run_all(
        spark,
        [
            lambda name=name, table=table: export_csv(table, f"{csv_path}/{name}", single_file, compression)
            for name, table in tables.items()
        ],
        at_once,
    )


def refresh_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    csv_path: str | None = None,
    *,
    fmt: str = "parquet",
    exact: bool = False,
    fraud_options: Mapping | None = None,
    dedup: str = "run",
    tie_breakers: Iterable[Column] | None = None,
    single_file: bool = False,
    csv_compression: str = "none",
    at_once: int = 4,
    buckets: int = BUCKETS,
) -> dict[str, DataFrame]:
    """Rewrites the eleven Gold tables, exports them as CSV, and returns the written tables.

    Silver is read six times, each time only the columns in question. The
    account and date dimensions are the group keys of facts already written,
    the four attribute dimensions come from one pass that writes their distinct
    combinations, and the CSV comes from the written tables. dedup="table" reads the latest row per
    transaction over all runs instead, from a table beside Gold that each refresh brings up
    to date from the Silver batches it does not have yet.

    The tables are overwritten one after the other, so a reader in between sees some of this refresh
    and some of the one before.
    """
    if dedup not in ("run", "table"):
        raise ValueError(f"dedup must be run or table, not {dedup!r}")
    if dedup == "run":
        silver = read_silver(spark, silver_path, fmt)
    elif fmt == "delta":
        current_path = f"{gold_path}/current_silver"
        overwrite_table(silver_current(read_silver(spark, silver_path, fmt), tie_breakers), current_path, fmt)
        silver = read_table(spark, current_path, fmt)
    else:
        silver = advance_current(spark, silver_path, f"{gold_path}/current_silver", fmt, buckets, tie_breakers)
    planned = gold_tables(silver, exact, fraud_options)
    combined = silver.select(*[KEY_DIMENSIONS[name] for name in ATTRIBUTE_DIMENSIONS]).distinct()
    combined_path = f"{gold_path}/attribute_combinations"

    def written(name: str) -> DataFrame:
        return read_table(spark, f"{gold_path}/{name}", fmt, schema_of(planned[name]))

    def write(name: str, df: DataFrame) -> Callable[[], None]:
        return lambda: overwrite_table(df, f"{gold_path}/{name}", fmt)

    run_all(
        spark,
        [write(name, planned[name]) for name in (*FACTS, "dim_customer")]
        + [lambda: overwrite_table(combined, combined_path, fmt)],
        at_once,
    )
    combined = read_table(spark, combined_path, fmt, schema_of(combined))
    derived = {
        "dim_date": dim_date(written("gold_transaction_summary")),
        "dim_account": written("gold_credit_risk").select("account_id"),
    } | {name: dim(combined, KEY_DIMENSIONS[name]) for name in ATTRIBUTE_DIMENSIONS}
    run_all(spark, [write(name, df) for name, df in derived.items()], at_once)
    tables = {name: written(name) for name in GOLD_TABLES}
    if csv_path is not None:
        export_all(spark, tables, csv_path, single_file, at_once, csv_compression)
    return tables

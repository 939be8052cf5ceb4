"""Gold kept up to date from new Silver batches only.

A full refresh reads all of Silver each time. Here every aggregate is kept as totals per key, in hash
buckets of the key, and a refresh merges the totals of the batches it does not have yet into the
buckets these have keys in; the row-level facts get the same batches. What is
read and written follows the increment, neither the length of the history nor the number of keys.

Which batches a table has is written down with it, by name, so the ingestion clock may step back: a late
batch is taken once like any other. Every Silver row counts, so it matches a full
refresh with dedup="run".
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyrock.functions import risk_score
from tallyrock.functions.money import cents_of, is_finite
from tallyrock.operators.dims import KEY_DIMENSIONS, dim, dim_date
from tallyrock.operators.facts import fraud_fact, lifecycle_fact
from tallyrock.plans.gold import ATTRIBUTE_DIMENSIONS, GOLD_TABLES, export_all
from tallyrock.plans.side_by_side import run_all
from tallyrock.plans.silver import untaken_silver
from tallyrock.schema import BATCH_COLUMN, SILVER_TABLE_DDL
from tallyrock.sinks.buckets import BUCKET, BUCKETS, BucketedTable, State
from tallyrock.sinks.tables import overwrite_table, read_written_mark, replace_batch, replace_batches, write_mark
from tallyrock.sources.batches import batch_of
from tallyrock.sources.files import Journal
from tallyrock.sources.tables import read_or_none, read_table, schema_of

#: Tables of few keys need few files.
SMALL_BUCKETS = 4
SUM_OF_CENTS = "decimal(28,2)"


@dataclass(frozen=True)
class Measure:
    """How a total starts from rows, and how two totals of a key become one."""

    start: Callable[[], Column]
    merge: Callable[[Column], Column]


def _sum_of_cents(cents: Column) -> Column:
    return F.sum(cents).cast(SUM_OF_CENTS)


ROWS = {"row_total": Measure(lambda: F.count("*"), F.sum)}
AMOUNTS = ROWS | {
    "amount": Measure(lambda: F.sum("txn_amount"), F.sum),
    "cents": Measure(
        lambda: _sum_of_cents(cents_of("txn_amount")),
        _sum_of_cents,
    ),
    "all_finite": Measure(lambda: F.bool_and(is_finite("txn_amount")), F.bool_and),
    "filled": Measure(lambda: F.count("txn_amount"), F.sum),
    "settled": Measure(lambda: F.sum("is_settled"), F.sum),
    "high_value": Measure(lambda: F.sum("high_value_flag"), F.sum),
}


@dataclass(frozen=True)
class Rollup:
    keys: tuple[str, ...]
    measures: dict[str, Measure]
    few_keys: bool = False

    def start(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(
            *[measure.start().alias(name) for name, measure in self.measures.items()]
        )

    def merge(self, totals: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
        return totals.groupBy(*(keys or self.keys)).agg(
            *[measure.merge(F.col(name)).alias(name) for name, measure in self.measures.items()]
        )

    def table(self, spark: SparkSession, path: str, buckets: int) -> BucketedTable:
        """The totals; buckets is their number in a new table of many keys."""
        schema = schema_of(self.start(spark.createDataFrame([], SILVER_TABLE_DDL)))
        return BucketedTable(spark, path, self.keys, schema, min(buckets, SMALL_BUCKETS) if self.few_keys else buckets)


ROLLUPS = {
    "accounts": Rollup(("account_id",), AMOUNTS),
    "days": Rollup(("txn_date_only",), AMOUNTS, few_keys=True),
    "customers": Rollup(("customer_id",), ROWS),
    "attributes": Rollup(tuple(KEY_DIMENSIONS[name] for name in ATTRIBUTE_DIMENSIONS), ROWS, few_keys=True),
}
BATCH_FACTS = {"gold_transaction_lifecycle": lifecycle_fact, "gold_fraud_detection": fraud_fact}


def advance_rollup(
    spark: SparkSession,
    rollup: Rollup,
    silver: str,
    path: str,
    fmt: str = "parquet",
    buckets: int = BUCKETS,
) -> tuple[BucketedTable, State]:
    """Brings the totals at path up to date with Silver's batches; returns them and their state."""
    table = rollup.table(spark, path, buckets)
    state = table.state()
    new, rows = untaken_silver(spark, silver, state.taken, fmt)
    if new:
        state = table.merge(state, rows, new, prepare=rollup.start, combine=rollup.merge, keep=True)
    return table, state


def add_fact_batches(
    spark: SparkSession,
    fact: Callable[..., DataFrame],
    silver: str,
    path: str,
    fmt: str = "parquet",
) -> DataFrame:
    """Adds Silver's batches that the fact does not have yet; returns the whole table.

    The batches are noted last, so those of a refresh that stopped are written again, in place.
    """
    planned = fact(spark.createDataFrame([], SILVER_TABLE_DDL))
    schema = f"{schema_of(planned)}, {BATCH_COLUMN} STRING"
    journal = Journal(spark, f"{path.rstrip('/')}_taken")
    number, note = journal.last()
    taken = set() if note is None else set(note["taken"])
    new, rows = untaken_silver(spark, silver, taken, fmt)
    if new:
        # Of one batch the id is known: no sort by it. A name of another form may not be the id letter by letter.
        if len(new) == 1 and batch_of(new[0]) is not None:
            replace_batch(fact(rows), path, new[0], fmt)
        else:
            replace_batches(fact(rows, BATCH_COLUMN), path, fmt)
        journal.add(number, {"taken": sorted(taken | set(new))})
    stored = read_or_none(spark, path, fmt, schema)
    return planned if stored is None else stored.select(*planned.columns)


def publish_buckets(
    table: BucketedTable,
    state: State,
    derive: Callable[[DataFrame], DataFrame],
    path: str,
    fmt: str = "parquet",
    form: str = "",
) -> DataFrame:
    """Writes what derive makes of the totals, for the buckets that have changed since the last time.

    The table is partitioned by bucket, and a bucket is replaced as a whole. What has been published is
    noted last, so a stopped refresh is made good by the next. A table of another form, such as
    with sums of another kind, is written anew.
    """
    spark = table.spark
    marker = read_written_mark(spark, path, "version BIGINT, form STRING")
    if marker is not None and marker["form"] != form:
        marker = None
    known = 0 if marker is None else marker["version"]
    changed = [b for b, v in state.versions.items() if v > known]
    derived = derive(table.read(state, changed, keep_bucket=True))
    if changed:
        writer = derived.repartition(len(changed), BUCKET).write.format(fmt).mode("overwrite").partitionBy(BUCKET)
        writer.option("partitionOverwriteMode", "static" if marker is None else "dynamic").save(path)
        write_mark(spark, path, version=state.version, form=form)
    schema = schema_of(derived.drop(BUCKET))
    stored = read_or_none(spark, path, fmt, f"{schema}, {BUCKET} INT")
    return spark.createDataFrame([], schema) if stored is None else stored.drop(BUCKET)


def _bucket(totals: DataFrame) -> list[str]:
    return [c for c in totals.columns if c == BUCKET]


def _money(exact: bool) -> tuple[Column, Column]:
    cents = F.col("cents").cast("double")
    total = F.when(F.col("all_finite"), cents).otherwise(F.col("amount")) if exact else F.col("amount")
    return total, F.when(F.col("filled") > 0, total / F.col("filled"))


def credit_risk_from_totals(accounts: DataFrame, exact: bool = False) -> DataFrame:
    total, average = _money(exact)
    return accounts.select(
        *_bucket(accounts),
        "account_id",
        total.alias("total_spend"),
        average.alias("avg_txn"),
        F.col("row_total").alias("txn_count"),
        F.col("high_value").alias("high_value_txns"),
        risk_score("high_value", "row_total").alias("risk_score"),
    )


def summary_from_totals(days: DataFrame, exact: bool = False) -> DataFrame:
    total, average = _money(exact)
    return days.select(
        "txn_date_only",
        F.col("row_total").alias("total_txns"),
        total.alias("total_amount"),
        average.alias("avg_amount"),
        F.col("settled").alias("settled_txns"),
    )


def refresh_gold_increment(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    csv_path: str | None = None,
    *,
    fmt: str = "parquet",
    exact: bool = False,
    fraud_options: Mapping | None = None,
    single_file: bool = False,
    at_once: int = 4,
    buckets: int = BUCKETS,
) -> dict[str, DataFrame]:
    """Brings all eleven Gold tables up to date, exports them and returns them.

    Totals are kept under totals in gold_path, with `buckets` for those of accounts and customers when
    they are new. The row-level facts carry batch_id as a partition column, the tables
    of accounts and customers bucket; use a Gold path of its own, apart from one
    that refresh_gold overwrites. A refresh that stopped half way is completed
    by the next one. Two at once on one Gold path do not count twice: one of them fails.
    """
    row_facts = BATCH_FACTS | {"gold_fraud_detection": partial(fraud_fact, **dict(fraud_options or {}))}
    kept = [
        lambda name=name, rollup=rollup: advance_rollup(
            spark, rollup, silver_path, f"{gold_path}/totals/{name}", fmt, buckets
        )
        for name, rollup in ROLLUPS.items()
    ] + [
        lambda name=name, fact=fact: add_fact_batches(spark, fact, silver_path, f"{gold_path}/{name}", fmt)
        for name, fact in row_facts.items()
    ]
    done = dict(zip([*ROLLUPS, *BATCH_FACTS], run_all(spark, kept, at_once)))
    days, attributes = (table.read(state) for table, state in (done["days"], done["attributes"]))
    by_bucket = {
        "gold_credit_risk": ("accounts", partial(credit_risk_from_totals, exact=exact)),
        "dim_account": ("accounts", lambda totals: totals.select(BUCKET, "account_id")),
        "dim_customer": ("customers", lambda totals: totals.select(BUCKET, "customer_id")),
    }
    whole = {
        "gold_transaction_summary": summary_from_totals(days, exact),
        "dim_date": dim_date(days),
    } | {name: dim(attributes, KEY_DIMENSIONS[name]) for name in ATTRIBUTE_DIMENSIONS}

    def write_whole(name: str, df: DataFrame) -> DataFrame:
        overwrite_table(df, f"{gold_path}/{name}", fmt)
        return read_table(spark, f"{gold_path}/{name}", fmt, schema_of(df))

    actions = {
        name: lambda name=name, totals=totals, derive=derive: publish_buckets(
            *done[totals], derive, f"{gold_path}/{name}", fmt, f"exact={exact}"
        )
        for name, (totals, derive) in by_bucket.items()
    } | {name: lambda name=name, df=df: write_whole(name, df) for name, df in whole.items()}
    written = dict(zip(actions, run_all(spark, actions.values(), at_once)))
    tables = {name: done[name] for name in BATCH_FACTS} | {name: written[name] for name in GOLD_TABLES if name in written}
    if csv_path is not None:
        export_all(spark, tables, csv_path, single_file, at_once)
    return tables

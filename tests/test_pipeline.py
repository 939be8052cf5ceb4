"""Silver runs, Gold refreshes and the pipeline over written tables."""

import re
import shutil

import pytest
from plans import plan_of
from pyspark.sql import functions as F

from tallyrock.operators.incremental import read_mark
from tallyrock.plans.gold import GOLD_TABLES, gold_tables, refresh_gold
from tallyrock.plans.gold_increment import refresh_gold_increment
from tallyrock.plans.pipeline import run_pipeline
from tallyrock.plans.silver import (
    batches_since,
    read_silver_since,
    run_silver,
    silver_current,
    silver_increment,
    silver_mark,
)
from tallyrock.schema import BATCH_COLUMN, BRONZE_DDL, SILVER_TABLE_DDL
from tallyrock.sinks.tables import mark_path, replace_batch
from tallyrock.sources.tables import read_table

FIRST, SECOND, THIRD = (f"2025-04-0{day} 10:00:00" for day in (1, 2, 3))


def add_bronze(rows, path):
    rows.write.mode("append").partitionBy("ingestion_date").parquet(path)


def read_silver(spark, path):
    return read_table(spark, path, schema=SILVER_TABLE_DDL)


def ids(df):
    return sorted(row.event_id for row in df.select("event_id").collect())


def same(left, right):
    return sorted(map(repr, left.collect())) == sorted(map(repr, right.collect()))


@pytest.fixture
def paths(tmp_path):
    return {name: str(tmp_path / name) for name in ("bronze", "silver", "gold", "csv", "other")}


def test_runs_take_only_what_is_new(spark, bronze, paths):
    add_bronze(bronze({"event_id": "a"}, {"event_id": "b", "transaction_id": "T2"}, at=FIRST), paths["bronze"])
    assert run_silver(spark, paths["bronze"], paths["silver"]).rows == 2
    assert run_silver(spark, paths["bronze"], paths["silver"]).rows == 0
    add_bronze(
        bronze(
            {"event_id": "c", "transaction_id": "T3", "txn_date": "2019-01-01T00:00:00"},
            {"event_id": "d", "txn_amount": None, "at": THIRD},
            at=SECOND,
        ),
        paths["bronze"],
    )
    run = run_silver(spark, paths["bronze"], paths["silver"])
    assert run.rows == 1 and ids(run.preview) == ["c"]
    assert ids(read_silver(spark, paths["silver"])) == ["a", "b", "c"]


def test_duplicates_are_removed_within_a_run_only(spark, bronze, paths):
    add_bronze(bronze({"event_id": "a"}, {"event_id": "b"}, at=FIRST), paths["bronze"])
    run_silver(spark, paths["bronze"], paths["silver"])
    add_bronze(bronze({"event_id": "c"}, at=SECOND), paths["bronze"])
    run_silver(spark, paths["bronze"], paths["silver"])
    silver = read_silver(spark, paths["silver"])
    assert ids(silver) == ["b", "c"]
    assert ids(silver_current(silver)) == ["c"]


def test_a_run_that_stopped_half_way_is_replaced(spark, bronze, paths):
    """The files of a batch are there but its rows were not seen by the mark."""
    add_bronze(bronze({"event_id": "a"}, at=FIRST), paths["bronze"])
    run_silver(spark, paths["bronze"], paths["silver"])
    add_bronze(bronze({"event_id": "b"}, at=SECOND), paths["bronze"])
    micros = read_mark(read_silver(spark, paths["silver"]))
    torn = read_silver(spark, paths["silver"]).withColumn(BATCH_COLUMN, F.lit(f"from-{micros}"))
    torn.write.mode("append").partitionBy(BATCH_COLUMN).parquet(paths["silver"])
    run_silver(spark, paths["bronze"], paths["silver"])
    assert ids(read_silver(spark, paths["silver"])) == ["a", "b"]


def test_rows_without_an_ingestion_time_are_taken_by_a_first_run_only(spark, bronze, paths):
    unstamped = bronze({"event_id": "u"}).withColumn(
        "ingestion_time", F.lit(None).cast("timestamp")
    )
    add_bronze(unstamped.unionByName(bronze({"event_id": "a", "transaction_id": "T2"}, at=FIRST)), paths["bronze"])
    run_silver(spark, paths["bronze"], paths["silver"])
    assert ids(read_silver(spark, paths["silver"])) == ["a", "u"]
    add_bronze(unstamped, paths["bronze"])
    assert run_silver(spark, paths["bronze"], paths["silver"]).rows == 0


def test_normalizing_first_settles_padded_statuses(bronze):
    rows = bronze({"txn_status": " Settled"})
    assert silver_increment(rows).first().is_settled == 0
    assert silver_increment(rows, normalize_first=True).first().is_settled == 1
    assert silver_increment(rows).first().txn_status == "settled"


def test_a_failing_silver_keeps_gold_from_starting(spark, bronze, paths):
    with pytest.raises(Exception):
        run_pipeline(spark, paths["bronze"], paths["silver"], paths["gold"])
    with pytest.raises(Exception):
        spark.read.parquet(f"{paths['gold']}/dim_date").count()


def test_pipeline_is_idempotent(spark, bronze, paths):
    add_bronze(
        bronze(
            {"event_id": "a"},
            {"event_id": "b", "transaction_id": "T2", "account_id": "B", "channel": " POS"},
            {"event_id": "c", "transaction_id": "T3", "txn_date": "n/a"},
            at=FIRST,
        ),
        paths["bronze"],
    )
    first = run_pipeline(
        spark, paths["bronze"], paths["silver"], paths["gold"], paths["csv"]
    )
    before = {name: table.collect() for name, table in first.items()}
    second = run_pipeline(spark, paths["bronze"], paths["silver"], paths["gold"], paths["csv"])
    assert tuple(second) and set(second) == set(GOLD_TABLES)
    for name, table in second.items():
        assert sorted(map(repr, table.collect())) == sorted(map(repr, before[name])), name
    planned = gold_tables(read_silver(spark, paths["silver"]))
    for name in GOLD_TABLES:
        assert same(second[name], planned[name]), name
        exported = spark.read.schema(planned[name].schema).option("header", True)
        assert same(exported.csv(f"{paths['csv']}/{name}"), planned[name]), name


def test_gold_over_the_latest_rows(spark, bronze, paths):
    for event, at in (("a", FIRST), ("b", SECOND)):
        add_bronze(bronze({"event_id": event}, at=at), paths["bronze"])
        run_silver(spark, paths["bronze"], paths["silver"])
    by_run = refresh_gold(spark, paths["silver"], paths["gold"])
    assert by_run["gold_credit_risk"].first().txn_count == 2
    latest = refresh_gold(spark, paths["silver"], paths["other"], dedup="table")
    assert latest["gold_credit_risk"].first().txn_count == 1
    with pytest.raises(ValueError):
        refresh_gold(spark, paths["silver"], paths["gold"], dedup="none")


def test_running_totals_equal_a_full_refresh(spark, bronze, paths):
    steps = [
        bronze({"transaction_id": None}, at=FIRST),
        bronze(
            *[{"transaction_id": f"T{i}", "account_id": f"A{i % 3}", "txn_amount": i + 0.1} for i in range(1, 20)],
            at=FIRST,
        ),
        bronze(
            *[{"transaction_id": f"T{i}", "account_id": f"A{i % 5}", "txn_amount": 0.7 * i} for i in range(1, 9)],
            {"transaction_id": "X", "txn_date": "n/a", "merchant_category": None},
            at=SECOND,
        ),
        bronze({"transaction_id": "Y", "txn_amount": float("nan"), "account_id": "A1"}, at=THIRD),
    ]
    for rows in steps:
        add_bronze(rows, paths["bronze"])
        run_silver(spark, paths["bronze"], paths["silver"])
        full = gold_tables(read_silver(spark, paths["silver"]), exact=True)
        for _ in range(2):
            kept = refresh_gold_increment(spark, paths["silver"], paths["gold"], exact=True)
            assert set(kept) == set(GOLD_TABLES)
            for name in GOLD_TABLES:
                assert kept[name].columns == full[name].columns
                assert same(kept[name], full[name]), name


def test_running_totals_without_any_ingestion_time(spark, bronze, paths):
    rows = bronze({}).withColumn("ingestion_time", F.lit(None).cast("timestamp"))
    add_bronze(rows, paths["bronze"])
    run_silver(spark, paths["bronze"], paths["silver"])
    tables = refresh_gold_increment(spark, paths["silver"], paths["gold"])
    assert {name: table.count() for name, table in tables.items()} == dict.fromkeys(GOLD_TABLES, 1)


def test_several_missing_batches_are_added_together(spark, bronze, paths):
    for event, at in (("a", FIRST), ("b", SECOND), ("c", THIRD)):
        add_bronze(bronze({"event_id": event, "transaction_id": event}, at=at), paths["bronze"])
        run_silver(spark, paths["bronze"], paths["silver"])
    fact = refresh_gold_increment(spark, paths["silver"], paths["gold"])["gold_fraud_detection"]
    assert sorted(r.transaction_id for r in fact.collect()) == ["a", "b", "c"]
    assert "batch_id" not in fact.columns
    stored = spark.read.parquet(f"{paths['gold']}/gold_fraud_detection")
    assert stored.select(BATCH_COLUMN).distinct().count() == 3


def test_only_batches_since_a_mark_are_read(spark, bronze, paths):
    marks = []
    for event, at in (("a", FIRST), ("b", SECOND), ("c", THIRD)):
        add_bronze(bronze({"event_id": event, "transaction_id": event}, at=at), paths["bronze"])
        run_silver(spark, paths["bronze"], paths["silver"])
        marks.append(read_mark(read_silver(spark, paths["silver"])))
    streamed = read_silver(spark, paths["silver"]).filter("event_id = 'a'")
    replace_batch(streamed.drop(BATCH_COLUMN), paths["silver"], "stream-0")
    silver = read_silver(spark, paths["silver"])
    for mark, expected in zip(marks, (["a", "b", "c"], ["a", "c"], ["a"])):
        recent = silver.filter(batches_since(mark))
        assert ids(recent) == expected
        assert re.search(r"PartitionFilters: \[[^\]]*batch_id", plan_of(recent))
        assert "DataFilters: []" in plan_of(recent)


def test_gold_scans_only_the_columns_it_needs(spark, bronze, paths):
    add_bronze(bronze({}), paths["bronze"])
    run_silver(spark, paths["bronze"], paths["silver"])
    tables = gold_tables(read_silver(spark, paths["silver"]))
    risk = plan_of(tables["gold_credit_risk"], "formatted")
    assert "ReadSchema: struct<account_id:string,txn_amount:double,high_value_flag:int>" in risk
    assert plan_of(tables["dim_channel"]).count("HashAggregate") == 2
    assert "Exchange" not in plan_of(tables["gold_fraud_detection"])
    assert "Exchange" not in plan_of(tables["gold_transaction_lifecycle"])


def test_silver_shuffles_once_and_only_bronze_columns(spark, bronze, paths):
    add_bronze(bronze({}), paths["bronze"])
    rows = read_table(spark, paths["bronze"], schema=BRONZE_DDL)
    plan = plan_of(silver_increment(rows))
    assert plan.count("Exchange") == 1
    below_shuffle = plan[plan.index("Exchange") :]
    assert "txn_hour" not in below_shuffle and "lower(" not in below_shuffle
    for pushed in ("IsNotNull(transaction_id)", "GreaterThan(txn_amount,0.0)", "IsNotNull(txn_date)"):
        assert pushed in plan_of(silver_increment(rows), "formatted")


def test_a_run_reads_recent_folders_only(spark, bronze, paths):
    for day in range(1, 13):
        add_bronze(bronze({"event_id": f"{day}", "transaction_id": f"{day}"}, at=f"2025-03-{day:02d} 10:00:00"), paths["bronze"])
        run_silver(spark, paths["bronze"], paths["silver"])
    mark = silver_mark(spark, paths["silver"])
    assert mark == read_mark(read_silver(spark, paths["silver"]))
    recent = read_silver_since(spark, paths["silver"], mark - 2 * 86_400_000_000)
    assert len(recent.inputFiles()) == 2 and ids(recent) == ["11", "12"]
    assert sorted(ids(read_silver(spark, paths["silver"])), key=int) == [str(k) for k in range(1, 13)]


def test_without_its_note_the_mark_comes_from_the_table(spark, bronze, paths):
    add_bronze(bronze({"event_id": "a"}, at=FIRST), paths["bronze"])
    run_silver(spark, paths["bronze"], paths["silver"])
    noted = silver_mark(spark, paths["silver"])
    shutil.rmtree(mark_path(paths["silver"]))
    assert silver_mark(spark, paths["silver"]) == noted
    assert silver_mark(spark, f"{paths['silver']}-none") is None


def test_one_threshold_for_silver_and_the_fraud_rule(spark, bronze, paths):
    add_bronze(bronze({"txn_amount": 700.0, "txn_date": "2031-05-06T03:00:00"}, at=FIRST), paths["bronze"])
    tables = run_pipeline(
        spark, paths["bronze"], paths["silver"], paths["gold"],
        silver_options={"high_value_threshold": 500.0},
        gold_options={"fraud_options": {"amount_threshold": 500.0, "night": (23, 23), "home": "US"}},
    )
    assert tables["gold_transaction_lifecycle"].first().high_value_flag == 1
    assert tables["gold_fraud_detection"].first().fraud_flag == 1

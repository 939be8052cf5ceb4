"""Latest row per key, high-water mark, incremental filter."""

import datetime
import re

from hypothesis import HealthCheck, given, settings, strategies as st
from plans import plan_of
from pyspark.sql import functions as F

from tallyrock.operators import dedup
from tallyrock.operators.dedup import latest_per_key, latest_stored
from tallyrock.operators.incremental import high_water_mark, mark_column, new_since, read_mark


def test_latest_ingestion_wins(bronze):
    rows = bronze(
        {"event_id": "old", "at": "2025-04-01 10:00:00", "ingest_ts": "2026-01-01T00:00:00"},
        {"event_id": "new", "at": "2025-04-01 10:00:30", "ingest_ts": "2025-01-01T00:00:00"},
        {"event_id": "other", "transaction_id": "TXN2"},
    )
    kept = latest_per_key(rows).select("transaction_id", "event_id")
    assert sorted(kept.collect()) == [("TXN1", "new"), ("TXN2", "other")]
    assert latest_per_key(rows).columns == rows.columns


def test_ties_go_to_the_source_clock_then_the_event_id(bronze):
    rows = bronze(
        {"event_id": "a", "ingest_ts": "2025-04-01T10:00:00.2"},
        {"event_id": "z", "ingest_ts": "2025-04-01T10:00:00.1"},
        {"event_id": "b", "ingest_ts": "2025-04-01T10:00:00.2"},
        {"event_id": "y", "ingest_ts": "broken"},
    )
    assert latest_per_key(rows).first().event_id == "b"


def test_callers_choose_tie_breakers(bronze):
    rows = bronze({"event_id": "a", "txn_amount": 9.0}, {"event_id": "b", "txn_amount": 1.0})
    kept = latest_per_key(rows, tie_breakers=[F.col("txn_amount").desc()])
    assert kept.first().event_id == "a"


def test_missing_times_lose(bronze):
    rows = bronze({"event_id": "a"}).unionByName(
        bronze({"event_id": "z"}).withColumn("ingestion_time", F.lit(None).cast("timestamp"))
    )
    assert latest_per_key(rows).first().event_id == "a"


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 5), st.integers(0, 99)), max_size=30))
def test_one_row_per_key_as_in_a_plain_loop(spark, rows):
    frame = spark.createDataFrame(rows, "k INT, t INT, e INT")
    kept = latest_per_key(frame, ["k"], "t", [F.col("e").desc()]).collect()
    best = {}
    for k, t, e in rows:
        best[k] = max(best.get(k, (-1, -1)), (t, e))
    assert sorted(map(tuple, kept)) == sorted((k, t, e) for k, (t, e) in best.items())


def test_a_key_is_cut_to_one_row_per_task_before_the_shuffle(bronze):
    plan = plan_of(latest_per_key(bronze({})))
    partial, shuffle, final = (
        plan.index(text) for text in (", Partial", "Exchange hashpartitioning(transaction_id", ", Final")
    )
    assert final < shuffle < partial  # printed top down
    assert plan.count("Exchange") == 1


def test_a_hot_key_leaves_few_rows_in_the_shuffle(spark):
    rows = spark.range(300_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("t"),
        (F.col("id") * 7 % 1000).alias("e"),
    )
    kept = latest_per_key(rows, ["k"], "t", [F.col("e").desc()])
    assert kept.count() == 200_001
    assert kept.filter("k = -1").first().t == 299_997


def test_mark_of_an_empty_table_is_null(bronze):
    empty = bronze({}).limit(0)
    assert high_water_mark(empty).collect() == [(None,)]
    assert read_mark(empty) is None


def test_mark_keeps_microseconds(bronze):
    rows = bronze({"at": "2025-04-01 10:00:00.123456"}, {"at": "2025-04-01 09:59:59.999999"})
    micros = read_mark(rows)
    stamp = datetime.datetime(2025, 4, 1, 10, 0, 0, 123456, tzinfo=datetime.timezone.utc)
    assert micros == int(stamp.timestamp()) * 1_000_000 + 123456
    assert new_since(rows, mark_column(micros)).count() == 0
    assert new_since(rows, mark_column(micros - 1)).count() == 1


def test_without_a_mark_all_rows_are_new(bronze):
    rows = bronze({}).withColumn("ingestion_time", F.lit(None).cast("timestamp"))
    assert new_since(rows, None).count() == 1
    assert new_since(rows, mark_column(0)).count() == 0


def test_incremental_filter_prunes_days_and_row_groups(spark, bronze, folder):
    days = [f"2025-04-0{day} 10:00:00" for day in range(1, 10)]
    rows = bronze(*[{"event_id": day, "at": day} for day in days])
    rows.write.partitionBy("ingestion_date").parquet(folder)
    mark = mark_column(read_mark(rows.filter("event_id < '2025-04-07'")))
    stored = spark.read.parquet(folder)
    new = new_since(stored, mark, date_column="ingestion_date")
    assert sorted(r.event_id for r in new.collect()) == days[6:]
    plan = plan_of(new)
    assert "GreaterThan(ingestion_time" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*ingestion_date", plan)


def keyed_files(spark, folder, rows=40_000):
    """Rows in three files, one of more rows than a bitmap holds, with repeated, missing and tied keys."""
    some = spark.range(rows).selectExpr(
        "IF(id % 17 = 0, NULL, CAST(id % 30000 AS STRING)) AS transaction_id",
        "IF(id % 5 = 0, NULL, TIMESTAMP'2025-01-01' + MAKE_DT_INTERVAL(0, 0, 0, id % 7)) AS ingestion_time",
        "CAST(id AS STRING) AS event_id", "'x' AS ingest_ts", "CAST(hash(id) AS STRING) AS carried",
    )
    some.coalesce(1).write.parquet(folder)
    some.limit(1000).coalesce(1).withColumn("event_id", F.lit("later")).write.mode("append").parquet(folder)
    some.limit(0).write.mode("append").parquet(folder)
    return spark.read.parquet(folder)


def by_event(df):
    return sorted(df.collect(), key=lambda r: (r.event_id, r.carried, r.transaction_id or ""))


def test_stored_rows_are_picked_by_place_and_equal_the_window(spark, folder):
    rows = keyed_files(spark, folder).filter("event_id != '77'")
    assert by_event(latest_stored(rows)) == by_event(latest_per_key(rows))
    order = [F.col("carried").desc()]
    assert by_event(latest_stored(rows, tie_breakers=order)) == by_event(latest_per_key(rows, tie_breakers=order))
    none = rows.filter("event_id = 'none'")
    assert latest_stored(none).count() == 0 and latest_stored(none).columns == rows.columns


def test_equal_copies_of_a_stored_row_leave_one(spark, folder):
    for _ in range(3):
        spark.sql("SELECT 'T' transaction_id, 'e' event_id, 'x' ingest_ts, current_date() ingestion_time").write.mode(
            "append"
        ).parquet(folder)
    assert latest_stored(spark.read.parquet(folder)).count() == 1


def test_of_stored_rows_keys_and_order_alone_are_shuffled(spark, folder, monkeypatch):
    rows = keyed_files(spark, folder, 100)
    steps = plan_of(latest_stored(rows), "formatted").split("\n\n")
    shuffles = [step for step in steps if ") Exchange" in step and "Arguments: hash" in step]
    assert shuffles and not any("carried" in step for step in shuffles)
    monkeypatch.setattr(dedup, "PLACED_ROWS", 10)
    whole = latest_stored(rows)
    assert "bitmap" not in plan_of(whole) and by_event(whole) == by_event(latest_per_key(rows))

"""Tables in key buckets: the latest rows and running totals, merged with the batches they do not have."""

import os
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plans import plan_of
from tallyrock.operators.dedup import latest_per_key
from tallyrock.plans.current import advance_current, current_table
from tallyrock.plans.gold import GOLD_TABLES, gold_tables
from tallyrock.plans.gold_increment import ROLLUPS, Rollup, advance_rollup, refresh_gold_increment
from tallyrock.plans.silver import compact_silver, read_silver, run_silver, silver_current, silver_increment, untaken_silver
from tallyrock.schema import BATCH_COLUMN
from tallyrock.sinks.buckets import BUCKET, BucketedTable
from tallyrock.sinks.tables import replace_batch

DAYS = [f"2025-04-{day:02d} 10:00:00" for day in range(1, 29)]


def same(left, right):
    return sorted(map(repr, left.collect())) == sorted(map(repr, right.collect()))


def data_files(path):
    """Data files with their time and size."""
    found = Path(path).rglob("*.parquet")
    return {str(f): (os.stat(f).st_mtime_ns, os.stat(f).st_size) for f in found}


def batch(bronze, number, *events, at=None):
    return silver_increment(bronze(*events, at=at or DAYS[number]))


@pytest.fixture
def paths(tmp_path):
    return {name: str(tmp_path / name) for name in ("bronze", "silver", "current", "gold", "other")}


def test_the_latest_rows_equal_the_window_over_all_after_each_increment(spark, bronze, paths):
    for number in range(4):
        events = [{"transaction_id": f"T{(i * (number + 1)) % 40}", "event_id": f"{number}-{i}"} for i in range(30)]
        replace_batch(batch(bronze, number, *events), paths["silver"], f"stream-{number}")
        kept = advance_current(spark, paths["silver"], paths["current"], buckets=8)
        expected = silver_current(read_silver(spark, paths["silver"])).drop(BATCH_COLUMN)
        assert kept.columns == expected.columns and same(kept, expected)


def test_buckets_that_an_increment_does_not_touch_keep_their_files(spark, bronze, paths):
    replace_batch(batch(bronze, 0, *[{"transaction_id": f"T{i}"} for i in range(200)]), paths["silver"], "stream-0")
    advance_current(spark, paths["silver"], paths["current"], buckets=16)
    before = data_files(paths["current"])
    replace_batch(batch(bronze, 1, {"transaction_id": "T7", "event_id": "new"}), paths["silver"], "stream-1")
    kept = advance_current(spark, paths["silver"], paths["current"], buckets=16)
    after = data_files(paths["current"])
    # The file of the older version stays for one more merge, for readers that are still at it.
    assert set(before.items()) <= set(after.items()) and len(after) == len(before) + 1
    assert kept.count() == 200 and kept.filter("event_id = 'new'").count() == 1
    assert len(kept.inputFiles()) == 16
    unchanged = advance_current(spark, paths["silver"], paths["current"])
    assert data_files(paths["current"]) == after and unchanged.count() == 200


def test_a_merge_that_stopped_before_its_note_counts_for_nothing(spark, bronze, paths):
    replace_batch(batch(bronze, 0, *[{"transaction_id": f"T{i}"} for i in range(20)]), paths["silver"], "stream-0")
    advance_current(spark, paths["silver"], paths["current"], buckets=4)
    replace_batch(batch(bronze, 1, *[{"transaction_id": f"U{i}"} for i in range(20)]), paths["silver"], "stream-1")

    def stop():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        advance_current(spark, paths["silver"], paths["current"], check=stop)
    table = current_table(spark, paths["current"])
    assert table.state().version == 1 and table.read().count() == 20
    assert advance_current(spark, paths["silver"], paths["current"]).count() == 40


def test_two_merges_on_one_state_do_not_both_count(spark, bronze, paths):
    table = BucketedTable(spark, paths["current"], ["k"], "k STRING, n BIGINT", buckets=4)
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k STRING, n BIGINT")
    total = lambda r, keys: r.groupBy(*keys).agg(F.sum("n").alias("n"))
    stale = table.state()
    table.merge(stale, rows, ["one"], lambda r: r, total)
    with pytest.raises(RuntimeError):
        table.merge(stale, rows, ["two"], lambda r: r, total)
    assert sorted(map(tuple, table.read().collect())) == [("a", 1), ("b", 2)]
    assert table.state().taken == {"one"}


def test_a_note_that_was_not_finished_is_passed_over(spark, paths):
    table = BucketedTable(spark, paths["current"], ["k"], "k STRING, n BIGINT", buckets=4)
    rows = spark.createDataFrame([("a", 1)], "k STRING, n BIGINT")
    first = lambda r, keys: r.groupBy(*keys).agg(F.max("n").alias("n"))
    state = table.merge(table.state(), rows, ["one"], lambda r: r, first)
    Path(paths["current"], "_notes", f"{state.note + 1:012}").write_text('{"version": 2, "buck')
    assert table.state().taken == {"one"}
    table.merge(table.state(), rows.withColumn("n", F.lit(5).cast("long")), ["two"], lambda r: r, first)
    assert table.read().collect() == [("a", 5)] and table.state().taken == {"one", "two"}


def test_what_is_dealt_by_bucket_is_not_shuffled_again(bronze):
    rows = bronze({}).withColumn(BUCKET, F.pmod(F.xxhash64("transaction_id"), F.lit(8)).cast("int"))
    merged = latest_per_key(rows.repartition(5, BUCKET), [BUCKET, "transaction_id"])
    assert plan_of(merged).count("Exchange") == 1


def test_totals_written_follow_the_increment(spark, bronze, paths):
    events = [{"transaction_id": f"T{i}", "account_id": f"A{i}", "customer_id": f"C{i}"} for i in range(300)]
    replace_batch(batch(bronze, 0, *events), paths["silver"], "stream-0")
    refresh_gold_increment(spark, paths["silver"], paths["gold"], buckets=32)
    places = [f"{paths['gold']}/{name}" for name in ("totals/accounts", "totals/customers", "gold_credit_risk", "dim_account")]
    before = [data_files(place) for place in places]
    assert all(len(files) == 32 for files in before)
    replace_batch(batch(bronze, 1, {"transaction_id": "X", "account_id": "A5", "customer_id": "C5"}), paths["silver"], "stream-1")
    tables = refresh_gold_increment(spark, paths["silver"], paths["gold"], buckets=32)
    for place, old in zip(places, before):
        new = {f: v for f, v in data_files(place).items() if f not in old}
        assert len(new) == 1, place
    full = gold_tables(read_silver(spark, paths["silver"]))
    for name in GOLD_TABLES:
        assert same(tables[name], full[name]), name


def test_a_refresh_that_stopped_between_totals_and_tables_is_made_good(spark, bronze, paths):
    replace_batch(batch(bronze, 0, {"transaction_id": "a"}), paths["silver"], "stream-0")
    refresh_gold_increment(spark, paths["silver"], paths["gold"])
    replace_batch(batch(bronze, 1, {"transaction_id": "b"}), paths["silver"], "stream-1")
    # As if it stopped here: the totals have the batch, the table made of them does not.
    _, state = advance_rollup(spark, ROLLUPS["accounts"], paths["silver"], f"{paths['gold']}/totals/accounts")
    assert state.taken == {"stream-0", "stream-1"}
    for _ in range(2):
        tables = refresh_gold_increment(spark, paths["silver"], paths["gold"])
        assert tables["gold_credit_risk"].first().txn_count == 2


def test_late_batches_are_taken_once(spark, bronze, paths):
    order = (5, 20, 2, 9)
    for number, day in enumerate(order):
        rows = batch(bronze, 0, {"transaction_id": f"T{day}", "txn_amount": float(day)}, at=DAYS[day])
        replace_batch(rows, paths["silver"], f"stream-{number}")
        for _ in range(2):
            tables = refresh_gold_increment(spark, paths["silver"], paths["gold"], exact=True)
        full = gold_tables(read_silver(spark, paths["silver"]), exact=True)
        for name in GOLD_TABLES:
            assert same(tables[name], full[name]), name


def test_batches_of_a_run_that_has_not_ended_are_left(spark, bronze, paths):
    """A run's batch is there before its mark: it may still be written again with more rows."""
    add = lambda rows: rows.write.mode("append").partitionBy("ingestion_date").parquet(paths["bronze"])
    add(bronze({"transaction_id": "a"}, at=DAYS[0]))
    mark = run_silver(spark, paths["bronze"], paths["silver"]).preview.select(F.unix_micros("ingestion_time")).first()[0]
    part = read_silver(spark, paths["silver"]).drop(BATCH_COLUMN)
    replace_batch(part.withColumn("transaction_id", F.lit("torn")), paths["silver"], f"from-{mark}")
    assert untaken_silver(spark, paths["silver"], [])[0] == ["from-start"]
    add(bronze({"transaction_id": "b"}, {"transaction_id": "c"}, at=DAYS[1]))
    run_silver(spark, paths["bronze"], paths["silver"])
    new, rows = untaken_silver(spark, paths["silver"], ["from-start"])
    assert new == [f"from-{mark}"] and sorted(r[0] for r in rows.select("transaction_id").collect()) == ["b", "c"]


def test_merged_batches_are_taken_by_what_they_hold(spark, bronze, paths):
    for number in range(6):
        replace_batch(batch(bronze, number, {"transaction_id": f"T{number}"}), paths["silver"], f"stream-{number}")
        if number == 2:
            refresh_gold_increment(spark, paths["silver"], paths["gold"])
    assert compact_silver(spark, paths["silver"], fanout=5) == 1
    tables = refresh_gold_increment(spark, paths["silver"], paths["gold"])
    full = gold_tables(read_silver(spark, paths["silver"]))
    for name in GOLD_TABLES:
        assert same(tables[name], full[name]), name
    assert tables["gold_transaction_lifecycle"].count() == 6


def test_a_table_without_batches_is_refused(spark, bronze, paths):
    with pytest.raises(ValueError):
        refresh_gold_increment(spark, paths["other"], paths["gold"])


def test_a_bucket_that_outgrows_a_task_is_merged_in_slices_by_one_shuffle(spark, bronze, paths, monkeypatch):
    monkeypatch.setattr("tallyrock.sinks.buckets.SLICE_ROWS", 50, raising=False)
    plans = []

    def latest(rows, keys, **options):
        merged = latest_per_key(rows, keys, **options)
        plans.append(re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\)", plan_of(merged)))
        return merged

    monkeypatch.setattr("tallyrock.plans.current.latest_per_key", latest)
    for number in range(2):
        events = [{"transaction_id": f"T{i}", "event_id": f"{number}-{i}"} for i in range(400 - 100 * number)]
        replace_batch(batch(bronze, number, *events), paths["silver"], f"stream-{number}")
        kept = advance_current(spark, paths["silver"], paths["current"], buckets=2)
        assert same(kept, silver_current(read_silver(spark, paths["silver"])).drop(BATCH_COLUMN))
    assert all(len(shuffles) == 1 and int(shuffles[0]) >= 8 for shuffles in plans), plans
    assert len(kept.inputFiles()) > 2


def test_rows_of_an_increment_are_read_once_and_slices_follow_their_totals(spark, bronze, paths, monkeypatch):
    monkeypatch.setattr("tallyrock.sinks.buckets.SLICE_ROWS", 50)
    seen, plans = spark.sparkContext.accumulator(0), []

    def counted(*args):
        new, rows = untaken_silver(*args)
        return new, rows.withColumn("account_id", F.udf(lambda key: seen.add(1) or key)("account_id"))

    class Watched(Rollup):
        def merge(self, totals, keys=None):
            merged = super().merge(totals, keys)
            plans.append(re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\)", plan_of(merged)))
            return merged

    monkeypatch.setattr("tallyrock.plans.gold_increment.untaken_silver", counted)
    accounts = Watched(ROLLUPS["accounts"].keys, ROLLUPS["accounts"].measures)
    events = [{"transaction_id": f"T{i}", "account_id": [None, "a", "b", "c"][i % 4], "txn_amount": 1.5} for i in range(400)]
    rows = batch(bronze, 0, *[e for e in events if e["account_id"]])
    replace_batch(rows, paths["silver"], "stream-0")
    # What a merge that was killed has left is removed by the next.
    os.makedirs(f"{paths['other']}/_aside-killed")
    table, state = advance_rollup(spark, accounts, paths["silver"], paths["other"], buckets=2)
    assert seen.value == 300
    assert all(len(shuffles) == 1 and int(shuffles[0]) <= 4 for shuffles in plans), plans
    assert sorted((r.account_id, r.row_total, r.amount) for r in table.read(state).collect()) == [(a, 100, 150.0) for a in "abc"]
    assert not [name for name in os.listdir(paths["other"]) if name.startswith("_aside")]


def test_a_fact_of_one_batch_is_written_under_its_name_without_a_sort(spark, bronze, paths, monkeypatch):
    def sorts(*args):
        raise AssertionError("written by a sort of its rows")

    monkeypatch.setattr("tallyrock.plans.gold_increment.replace_batches", sorts)
    for number in range(2):
        replace_batch(batch(bronze, number, {"transaction_id": f"T{number}"}), paths["silver"], f"stream-{number}")
        tables = refresh_gold_increment(spark, paths["silver"], paths["gold"])
    full = gold_tables(read_silver(spark, paths["silver"]))
    for name in GOLD_TABLES:
        assert same(tables[name], full[name]), name
    kept = spark.read.parquet(f"{paths['gold']}/gold_fraud_detection").select("transaction_id", BATCH_COLUMN).collect()
    assert sorted(map(tuple, kept)) == [("T0", "stream-0"), ("T1", "stream-1")]

"""Names of batches, the covering set, and compaction level by level."""

import math
from pathlib import Path

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyrock.plans.lease import LeaseHeld, LeaseLost, lease
from tallyrock.plans.silver import compact_silver, read_silver, read_silver_since, run_silver, silver_increment
from tallyrock.schema import BATCH_COLUMN, SILVER_DDL, SILVER_TABLE_DDL
from tallyrock.sinks.tables import replace_batches
from tallyrock.sources.batches import (
    batch_of,
    compact,
    covering,
    leaves_of,
    next_merge,
    read_batches,
    read_leaves,
    stored_batches,
)


@pytest.fixture
def silver(spark, bronze, tmp_path):
    """Writes one row per batch number, each in a batch of its own; returns the path."""

    def write(numbers, prefix="stream"):
        path = str(tmp_path / "silver")
        one = silver_increment(bronze({}))
        rows = spark.createDataFrame([(n,) for n in numbers], "n BIGINT").coalesce(1).crossJoin(one.drop("event_id"))
        rows = rows.withColumn("event_id", F.col("n").cast("string"))
        rows = rows.withColumn("ingestion_time", F.timestamp_micros("n")).withColumn(BATCH_COLUMN, F.concat(F.lit(f"{prefix}-"), "n"))
        replace_batches(rows.drop("n"), path)
        return path

    return write


def ids(rows):
    return sorted(int(r[0]) for r in rows.select("event_id").collect())


def test_names():
    assert batch_of("only") is None and batch_of("from-") is None
    leaf, merged = batch_of("from-start"), batch_of("from-start-to-70-level-2")
    assert leaf.level == 0 and leaf.end is None and merged.end == 70
    assert merged.covers(leaf) and merged.covers(batch_of("from--5")) and not merged.covers(batch_of("from-70"))
    assert not merged.covers(batch_of("stream-3")) and not merged.covers(merged)


def test_the_covering_set_prefers_what_is_merged():
    names = ["from-start", "from-5", "from-9", "from-start-to-9-level-1", "only", "stream-0"]
    assert covering(names) == ["from-9", "from-start-to-9-level-1", "only", "stream-0"]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 300), st.integers(2, 9))
def test_levels_stay_logarithmic_and_hold_every_leaf_once(n, fanout):
    """Compaction after every batch, by names alone."""
    held = {}
    for number in range(n):
        held[f"stream-{number}"] = [number]
        while (found := next_merge(held, fanout)) is not None:
            group, after = found
            name = f"stream-{group[0].start}-to-{after.start}-level-{group[0].level + 1}"
            merged = [x for b in group for x in held[b.name]]
            assert batch_of(name).covers(group[0]) and after.name in held
            held[name] = merged
            assert sorted(x for k in covering(held) for x in held[k]) == list(range(number + 1))
            for b in group:
                del held[b.name]
    assert sorted(x for v in held.values() for x in v) == list(range(n))
    assert len(held) <= fanout * (1 + math.log(n, fanout))


def test_200_batches_leave_few_folders_and_equal_rows(spark, silver):
    path = silver(range(200))
    assert compact_silver(spark, path) == 24 + 3
    # Three of 64, none of 8 left, and the eight newest.
    assert len(stored_batches(spark, path)) == 3 + 0 + 8
    rows = read_silver(spark, path)
    assert ids(rows) == list(range(200))
    assert {r[0] for r in rows.select(BATCH_COLUMN).distinct().collect()} == {f"stream-{n}" for n in range(200)}
    assert compact_silver(spark, path) == 0


def test_a_merge_may_stop_anywhere(spark, silver):
    path = silver(range(6))

    class Stopped(Exception):
        pass

    def stop():
        raise Stopped

    with pytest.raises(Stopped):  # written aside, not yet in place
        compact(spark, path, SILVER_DDL, fanout=3, check=stop)
    assert any(p.name.startswith("_merging-") for p in Path(path).iterdir())
    assert ids(read_silver(spark, path)) == list(range(6))
    # In place, but what it covers is not yet deleted.
    kept = read_leaves(spark, path, "parquet", SILVER_TABLE_DDL, ["stream-0", "stream-1"])
    again = spark.createDataFrame(kept.collect(), kept.schema)
    assert compact(spark, path, SILVER_DDL, fanout=3) == 1
    replace_batches(again, path)
    assert len(stored_batches(spark, path)) == 6 and ids(read_silver(spark, path)) == list(range(6))
    compact(spark, path, SILVER_DDL, fanout=3)
    assert sorted(stored_batches(spark, path)) == ["stream-0-to-3-level-1", "stream-3", "stream-4", "stream-5"]
    assert not any(p.name.startswith("_merging-") for p in Path(path).iterdir())


def test_leaves_and_marks_reach_into_merged_folders(spark, silver):
    path = silver([10, 20, 30, 40, 50], prefix="from")
    assert compact(spark, path, SILVER_DDL, fanout=2) == 3
    assert sorted(stored_batches(spark, path)) == ["from-10-to-50-level-2", "from-50"]
    assert leaves_of(spark, path, "from-10-to-50-level-2") == [f"from-{n}" for n in (10, 20, 30, 40)]
    assert ids(read_leaves(spark, path, "parquet", SILVER_TABLE_DDL, ["from-20", "from-50"])) == [20, 50]
    assert ids(read_silver_since(spark, path, 30)) == [30, 40, 50]
    only = read_silver_since(spark, path, 50)
    assert ids(only) == [50] and len(only.inputFiles()) == 1


def test_runs_go_on_after_compaction(spark, bronze, tmp_path):
    paths = {name: str(tmp_path / name) for name in ("bronze", "silver")}
    for day in range(1, 8):
        rows = bronze({"event_id": str(day), "transaction_id": f"T{day}"}, at=f"2025-04-0{day} 10:00:00")
        rows.write.mode("append").partitionBy("ingestion_date").parquet(paths["bronze"])
        assert run_silver(spark, paths["bronze"], paths["silver"]).rows == 1
        compact_silver(spark, paths["silver"], fanout=2)
    assert ids(read_silver(spark, paths["silver"])) == list(range(1, 8))
    assert len(stored_batches(spark, paths["silver"])) <= 4
    assert run_silver(spark, paths["bronze"], paths["silver"]).rows == 0


def test_tables_without_merged_folders_are_read_as_before(spark, silver):
    path = silver(range(3))
    plan = read_batches(spark, path, "parquet", SILVER_TABLE_DDL)
    assert plan.columns[-1] == BATCH_COLUMN and "leaf" not in "".join(plan.columns)
    with pytest.raises(ValueError):
        compact(spark, path, SILVER_DDL, fmt="delta")
    with pytest.raises(ValueError):
        compact(spark, path, SILVER_DDL, fanout=1)


def test_compaction_waits_for_its_turn(spark, silver):
    path = silver(range(20))
    with lease(spark, path):
        with pytest.raises(LeaseHeld):
            compact_silver(spark, path)
    assert compact_silver(spark, path) == 2


def test_compaction_that_lost_its_turn_changes_nothing(spark, silver):
    path = silver(range(4))
    with pytest.raises(LeaseLost):
        with lease(spark, path, seconds=30) as turn:
            (Path(f"{path}_lease") / f"{turn.number + 1:012}").write_text("another driver")
            compact(spark, path, SILVER_DDL, fanout=2, check=turn.check)
    assert len(stored_batches(spark, path)) == 4 and ids(read_silver(spark, path)) == [0, 1, 2, 3]

"""Messages of an account in order on a bus."""

import re
from pathlib import Path

import pytest
from plans import plan_of
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from tallyrock.sinks.publish import SORT_SLICES, dealt_by_key, in_key_order, send_partitions


def file_sender(folder, broken=False):
    """Opens one file per partition; a task that is repeated starts it anew."""

    class FileSender:
        def __init__(self, number):
            self.name = f"{folder}/{number}"
            self.file = open(self.name, "w", encoding="utf-8")

        def send(self, key, value):
            if broken:
                raise OSError("bus is gone")
            self.file.write(f"{key}\t{value}\n")

        def close(self):
            self.file.close()
            if broken:
                open(f"{self.name}.closed", "w").close()

    return FileSender


def messages(spark, rows):
    """A third of the messages are of one account; they arrive in no order."""
    key = F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 10 == 1, None).otherwise(F.concat(F.lit("A"), F.col("id") % 50))
    mixed = spark.range(rows, numPartitions=7).select(key.alias("key"), F.lpad(F.col("id").cast("string"), 8, "0").alias("value"))
    return mixed.repartition(9)


def test_every_account_is_in_one_file_in_order(spark, tmp_path):
    folder = str(tmp_path)
    dealt = dealt_by_key(messages(spark, 30_000), 6, "value")
    progress = send_partitions(dealt, file_sender(folder))
    assert progress.records == 30_000 and progress.records_per_second > 0
    files = {p.name: [line.rstrip("\n").split("\t") for line in p.open()] for p in Path(folder).iterdir()}
    assert set(files) == {str(n) for n in range(6)}
    place, last = {}, {}
    for name, lines in files.items():
        for key, value in lines:
            if key == "None":
                continue
            assert place.setdefault(key, name) == name and last.get(key, "") < value
            last[key] = value
    assert sum(map(len, files.values())) == 30_000 and len(last) > 30
    without_key = [sum(key == "None" for key, _ in lines) for lines in files.values()]
    assert min(without_key) > 0  # spread, not all in one


def test_dealing_takes_one_shuffle(spark):
    plan = plan_of(dealt_by_key(messages(spark, 10).coalesce(1), 6, "value"))
    assert plan.count("hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan


def test_a_sender_is_closed_when_sending_fails(spark, tmp_path):
    with pytest.raises(PythonException, match="bus is gone"):
        send_partitions(dealt_by_key(messages(spark, 10), 1), file_sender(str(tmp_path), broken=True))
    assert (tmp_path / "0.closed").exists()


def test_an_order_is_worked_out_once_a_row_and_not_in_every_comparison(spark):
    rows = messages(spark, 1000)
    number = F.get_json_object(F.concat(F.lit('{"n":'), "value", F.lit("}")), "$.n").cast("long")
    for ordered in (in_key_order(rows, number, "value", partitions=3), dealt_by_key(rows, 3, number)):
        assert ordered.columns == ["key", "value"]
        assert not re.search(r"Sort \[.*get_json_object", plan_of(ordered))
        for part in ordered.rdd.glom().collect():
            found = [(r.key or "", int(r.value)) for r in part if r.key]
            by_key = {k: [v for key, v in found if key == k] for k, _ in found}
            assert all(v == sorted(v) for v in by_key.values())


def test_a_bus_partition_is_sorted_in_parts_and_a_key_stays_in_one(spark):
    dealt = dealt_by_key(messages(spark, 3000), 4, "value")
    assert "hashpartitioning(coalesce(key" in plan_of(dealt) and f", {4 * SORT_SLICES})" in plan_of(dealt)
    parts = dealt.rdd.glom().collect()
    holders = [{r.key for r in part if r.key} for part in parts]
    assert len(parts) <= 4 and sum(map(len, holders)) == len(set().union(*holders))

"""Sources and sinks."""

import glob
import json
import os

import pyarrow.parquet as pq
import pytest
from samples import payload
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyrock.operators.facts import lifecycle_fact
from tallyrock.operators.payload import lines_to_messages, parse, to_messages
from tallyrock.plans.silver import silver_increment
from tallyrock.operators.incremental import recent_day
from tallyrock.schema import BRONZE_DDL, PAYLOAD_DDL, SILVER_TABLE_DDL
from tallyrock.session import scratch_path, shared_dir
from tallyrock.sinks.csv import export_csv
from tallyrock.sinks.publish import in_key_order, publish
from tallyrock.sinks.tables import append_table, overwrite_table, replace_batch, report
from tallyrock.sources.messages import read_lines
from tallyrock.sources.tables import path_exists, read_folders, read_or_none, read_table


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n INT")


def stored(spark, path):
    return sorted(row.n for row in spark.read.parquet(path).select("n").collect())


def test_append_adds_and_overwrite_replaces(spark, folder):
    append_table(numbers(spark, 1, 2), folder)
    append_table(numbers(spark, 2), folder)
    assert stored(spark, folder) == [1, 2, 2]
    overwrite_table(numbers(spark, 9), folder)
    assert stored(spark, folder) == [9]


def test_a_repeated_batch_replaces_itself_only(spark, folder):
    replace_batch(numbers(spark, 1, 2), folder, "first")
    replace_batch(numbers(spark, 3), folder, "second")
    replace_batch(numbers(spark, 1, 2, 4), folder, "first")
    assert stored(spark, folder) == [1, 2, 3, 4]
    assert report(spark, folder, batch_id="first").rows == 3
    assert report(spark, folder).preview.count() == 4


def test_report_previews_five_rows(spark, folder):
    append_table(numbers(spark, *range(9)), folder)
    written = report(spark, folder)
    assert (written.rows, written.preview.count()) == (9, 5)


def test_only_a_missing_path_means_no_table(spark, folder, tmp_path):
    assert read_or_none(spark, folder) is None
    assert read_or_none(spark, folder, schema="n INT") is None
    os.makedirs(folder)
    with pytest.raises(AnalysisException):
        read_or_none(spark, folder)  # a folder without files has no schema to find
    assert read_or_none(spark, folder, schema="n INT").count() == 0
    with pytest.raises(Exception):
        read_or_none(spark, folder, fmt="no-such-format")


def test_path_exists_for_files_and_hidden_folders(spark, tmp_path):
    (tmp_path / "_spark_metadata").mkdir()
    (tmp_path / "_spark_metadata" / "0").write_text("x")
    (tmp_path / "metadata").write_text("x")
    (tmp_path / "empty").mkdir()
    for name in ("_spark_metadata", "metadata", "empty"):
        assert path_exists(spark, str(tmp_path / name)), name
    assert not path_exists(spark, str(tmp_path / "none"))


def test_lines_come_from_matching_files_only(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text(json.dumps(payload(event_id="1")) + "\n\n")
    (tmp_path / "b.ndjson").write_text(json.dumps(payload(event_id="2")))
    (tmp_path / "c.csv").write_text("x,y\n")
    lines = read_lines(spark, str(tmp_path))
    assert lines.count() == 3
    messages = lines_to_messages(lines.filter("value <> ''"), strict=True)
    assert sorted(r.event_id for r in parse(messages).collect()) == ["1", "2"]
    assert {r.key for r in messages.collect()} == {"ACCT1"}


def test_publish_counts_and_writes_every_message(spark, folder):
    events = spark.createDataFrame(
        [tuple(payload(event_id=str(i), settlement_date=None).values()) for i in range(50)],
        PAYLOAD_DDL,
    )
    progress = publish(to_messages(events), "text", folder)
    assert progress.records == 50 and progress.records_per_second > 0
    lines = [line for path in glob.glob(f"{folder}/part-*") for line in open(path)]
    assert len(lines) == 50 and all('"settlement_date":null' in line for line in lines)


def test_key_order_holds_over_part_files_and_a_hot_key_is_split(spark, folder):
    messages = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        F.format_string("%06d", "id").alias("value"),
    )
    ranged = in_key_order(messages, "value", partitions=8)
    sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1500
    publish(ranged, "text", folder)
    values = [l.strip() for path in sorted(glob.glob(f"{folder}/part-*")) for l in open(path)]
    hot = [v for v in values if int(v) % 3 > 0]
    assert len(values) == 6000 and hot == sorted(hot)


def test_copies_of_one_message_are_split_by_origin(spark, tmp_path):
    line = json.dumps(payload()) + "\n"
    for i in range(16):
        (tmp_path / f"{i:02}.ndjson").write_text(line * 300)
    messages = lines_to_messages(read_lines(spark, str(tmp_path), origin=True))
    ranged = in_key_order(messages, "file", "block", partitions=8)
    sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4800 and max(sizes) <= 1200
    publish(ranged, "text", str(tmp_path / "sent"))
    assert spark.read.text(str(tmp_path / "sent")).filter(F.col("value") == line.strip()).count() == 4800


def test_csv_has_headers_and_utc_times(spark, bronze, folder):
    event = {"transaction_id": "T-7", "account_id": "A-8", "customer_id": "C-9"}
    rows = bronze(event, {"txn_status": "failed", "settlement_date": None, "txn_amount": 12345678.9})
    export_csv(lifecycle_fact(silver_increment(rows)).orderBy("transaction_id"), folder, single_file=True)
    (part,) = glob.glob(f"{folder}/part-*.csv")
    assert open(part).read().splitlines() == [
        # The header and the form of the values.
        "transaction_id,account_id,customer_id,txn_date,txn_amount,txn_status,settlement_date,"
        "days_to_settle,is_settled,high_value_flag",
        "T-7,A-8,C-9,2031-05-06T09:10:11.000Z,250.5,settled,2031-05-07T10:11:12.000Z,1,1,0",
        "TXN1,ACCT1,CUST1,2031-05-06T09:10:11.000Z,1.23456789E7,failed,,,0,1",
    ]


@pytest.mark.parametrize("rows", [100, 6_000_000])
def test_a_single_file_is_one_part_whatever_its_size(spark, folder, rows):
    export_csv(spark.range(0, rows, numPartitions=4), folder, single_file=True)
    assert len(glob.glob(f"{folder}/part-*.csv")) == 1
    assert spark.read.option("header", True).csv(folder).count() == rows
    export_csv(spark.range(0, 100, numPartitions=4), folder)
    assert len(glob.glob(f"{folder}/part-*.csv")) == 4


def test_times_are_stored_with_statistics(spark, bronze, folder):
    append_table(bronze({}).coalesce(1), folder)
    (part,) = glob.glob(f"{folder}/part-*.parquet")
    group = pq.ParquetFile(part).metadata.row_group(0)
    names = [group.column(i).path_in_schema for i in range(group.num_columns)]
    assert group.column(names.index("ingestion_time")).is_stats_set


def test_missing_silver_is_an_empty_table_with_a_schema(spark, bronze, folder):
    replace_batch(silver_increment(bronze({"transaction_id": None})), folder, "from-start")
    assert read_table(spark, folder, schema=SILVER_TABLE_DDL).count() == 0


def test_shared_folder_is_the_one_the_session_names(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark)
    if before:
        assert scratch_path(spark, "x").startswith(before)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_folders_that_are_not_wanted_are_not_listed(spark, bronze, folder):
    days = [{"event_id": str(k), "at": f"2025-01-{k:02d} 10:00:00"} for k in range(1, 31)]
    bronze(*days).write.partitionBy("ingestion_date").parquet(folder)
    mark = 1738144800000000  # 2025-01-29 10:00 UTC
    rows = read_folders(spark, folder, "ingestion_date", recent_day(mark), "parquet", BRONZE_DDL)
    assert sorted(int(r.event_id) for r in rows.collect()) == [27, 28, 29, 30]
    assert len(rows.inputFiles()) == 4
    assert read_folders(spark, folder, "ingestion_date", lambda day: False, "parquet", BRONZE_DDL).count() == 0

import json
import time

import pytest
from samples import payload
from plans import plan_of

from tallyrock.schema import BRONZE_DDL, SILVER_TABLE_DDL
from tallyrock.sinks.publish import StreamMeter
from tallyrock.sources.messages import message_stream
from tallyrock.sources.tables import read_table
from tallyrock.streaming import metrics
from tallyrock.streaming.bronze import UNTIL_DRAINED, bronze_rows as bronze_rows_of, ingest_bronze
from tallyrock.streaming.checkpoints import LostCheckpoint
from tallyrock.streaming.silver import stream_silver


@pytest.fixture
def lines(tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()

    def add(name, *events):
        text = "".join((e if isinstance(e, str) else json.dumps(e)) + "\n" for e in events)
        (folder / name).write_text(text)
        time.sleep(0.05)

    add.path = str(folder)
    return add


@pytest.fixture
def paths(tmp_path):
    names = ("bronze", "bronze-check", "silver", "silver-check")
    return {name: str(tmp_path / name) for name in names}


def ingest(spark, lines, paths, checkpoint="bronze-check", **options):
    messages = message_stream(spark, "text", {"path": lines.path, "maxFilesPerTrigger": "1"})
    query = ingest_bronze(
        messages, paths["bronze"], paths[checkpoint], trigger=UNTIL_DRAINED, **options
    )
    assert query.awaitTermination(120)
    return query


def bronze_rows(spark, paths):
    return read_table(spark, paths["bronze"], schema=BRONZE_DDL).collect()


def silver_ids(spark, paths):
    return sorted(r.event_id for r in read_table(spark, paths["silver"], schema=SILVER_TABLE_DDL).collect())


def refine(spark, paths, **options):
    query = stream_silver(
        spark, paths["bronze"], paths["silver"], paths["silver-check"], trigger=UNTIL_DRAINED, **options
    )
    assert query.awaitTermination(120)


def test_every_message_becomes_a_row_stamped_per_micro_batch(spark, lines, paths):
    lines("1.ndjson", payload(event_id="a"), "broken", payload(event_id="b"))
    lines("2.ndjson", payload(event_id="c"))
    meter = StreamMeter(spark, paths["bronze"], schema=BRONZE_DDL)
    ingest(spark, lines, paths)
    rows = bronze_rows(spark, paths)
    assert sorted(str(r.event_id) for r in rows) == ["None", "a", "b", "c"]
    assert len({r.ingestion_time for r in rows}) == 2
    assert {r.source for r in rows} == {"kafka_txn_stream"}
    assert meter.progress().records == 4


def test_restart_adds_only_new_files(spark, lines, paths):
    lines("1.ndjson", payload(event_id="a"))
    ingest(spark, lines, paths)
    ingest(spark, lines, paths)
    assert len(bronze_rows(spark, paths)) == 1
    lines("2.ndjson", payload(event_id="b"))
    ingest(spark, lines, paths)
    assert sorted(r.event_id for r in bronze_rows(spark, paths)) == ["a", "b"]


def test_a_lost_checkpoint_is_noticed(spark, lines, paths):
    lines("1.ndjson", payload())
    ingest(spark, lines, paths)
    with pytest.raises(LostCheckpoint):
        ingest(spark, lines, paths, checkpoint="silver-check")
    refine(spark, paths)
    with pytest.raises(LostCheckpoint):
        stream_silver(spark, paths["bronze"], paths["silver"], paths["silver"] + "-new")


def test_raw_text_and_flat_layout_on_request(spark, lines, paths):
    lines("1.ndjson", "broken")
    ingest(spark, lines, paths, keep_raw=True, partition_by=())
    (row,) = spark.read.parquet(paths["bronze"]).collect()
    assert row.raw_value == "broken"


def test_silver_stream_takes_each_file_once(spark, lines, paths):
    lines("1.ndjson", payload(event_id="a"), payload(event_id="b"), payload(transaction_id=None))
    ingest(spark, lines, paths)
    refine(spark, paths)
    refine(spark, paths)
    assert silver_ids(spark, paths) == ["b"]
    lines("2.ndjson", payload(event_id="c", transaction_id="T2"))
    ingest(spark, lines, paths)
    refine(spark, paths)
    assert silver_ids(spark, paths) == ["b", "c"]


def test_increments_equal_one_run_when_keys_do_not_repeat(spark, lines, paths):
    for i in range(4):
        lines(f"{i}.ndjson", *[payload(event_id=f"{i}{j}", transaction_id=f"T{i}{j}") for j in range(5)])
    ingest(spark, lines, paths)
    refine(spark, paths, source_options={"maxFilesPerTrigger": "1"})
    assert silver_ids(spark, paths) == [f"{i}{j}" for i in range(4) for j in range(5)]
    batches = read_table(spark, paths["silver"], schema=SILVER_TABLE_DDL).select("batch_id").distinct()
    assert batches.count() > 1


def test_ingestion_needs_no_shuffle(spark, lines):
    lines("1.ndjson", payload())
    batch = spark.read.text(lines.path)
    assert "Exchange" not in plan_of(bronze_rows_of(batch))


def test_a_bus_connector_that_is_not_there_is_reported(spark):
    with pytest.raises(Exception, match="kafka"):
        message_stream(spark)


def test_figures_of_every_micro_batch_are_kept_while_the_stream_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(metrics, "FOLD", 4)
    lines, table, figures = (str(tmp_path / name) for name in ("lines", "bronze", "figures"))
    (tmp_path / "lines").mkdir()
    for number in range(6):
        events = [payload(transaction_id=None if i == 0 else f"T{number}{i}") for i in range(number + 1)]
        (tmp_path / "lines" / f"{number}.txt").write_text("".join(json.dumps(e) + "\n" for e in events))
    listener = metrics.BatchMetrics(spark, figures)
    spark.streams.addListener(listener)
    try:
        messages = message_stream(spark, "text", {"path": lines, "maxFilesPerTrigger": "1"})
        ingest_bronze(messages, table, f"{table}-checkpoint", trigger={"availableNow": True}).awaitTermination()
        assert listener.wait()
    finally:
        spark.streams.removeListener(listener)
    kept = metrics.read_metrics(spark, figures)
    # Files of one instant come in any order.
    assert sorted(tuple(r) for r in kept.select("records", "without_id").collect()) == [(n + 1, 1) for n in range(6)]
    assert sorted(r.batch for r in kept.collect()) == list(range(6))
    assert kept.agg({"records": "sum"}).first()[0] == spark.read.parquet(table).count() == 21
    assert sorted(p.name.startswith("to-") for p in (tmp_path / "figures").iterdir() if p.suffix == ".json") == [False, False, True]
    listener.fold(kept.first()["run"])
    assert metrics.read_metrics(spark, figures).count() == 6

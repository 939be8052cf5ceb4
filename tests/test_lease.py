"""Turns on a table."""

import threading
import time

import pytest

from tallyrock.plans.lease import LeaseHeld, LeaseLost, lease, lease_folder
from tallyrock.plans.pipeline import run_pipeline
from tallyrock.plans.side_by_side import run_all
from tallyrock.plans.silver import read_silver, run_silver, silver_mark
from tallyrock.sources.files import Journal, create_once, names_in, touch
from tallyrock.sources.tables import folder_names

FIRST, SECOND = "2025-04-01 10:00:00", "2025-04-02 10:00:00"


@pytest.fixture
def paths(tmp_path):
    return {name: str(tmp_path / name) for name in ("bronze", "silver", "gold", "csv")}


def add(rows, path):
    rows.write.mode("append").partitionBy("ingestion_date").parquet(path)


def test_one_of_many_creates_a_file(spark, tmp_path):
    path, got = str(tmp_path / "deep" / "one"), []
    start = threading.Barrier(8)

    def create():
        start.wait()
        got.append(create_once(spark, path, "x"))

    threads = [threading.Thread(target=create) for _ in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(got) == [False] * 7 + [True]


def test_turns_follow_each_other(spark, folder):
    with lease(spark, folder) as first:
        with pytest.raises(LeaseHeld):
            with lease(spark, folder):
                pass
        first.check()
    with lease(spark, folder) as second:
        assert second.number == first.number + 1
        with pytest.raises(LeaseLost):
            first.check()
    with lease(spark, folder):
        pass
    assert len(names_in(spark, lease_folder(folder))) == 2  # the last turn and its release


def test_a_failing_job_gives_its_turn_back(spark, folder):
    with pytest.raises(ZeroDivisionError):
        with lease(spark, folder):
            1 / 0
    with lease(spark, folder):
        pass


def test_a_silent_holder_is_taken_over_and_a_lively_one_is_not(spark, folder):
    with lease(spark, folder, seconds=0.6):
        time.sleep(1.5)  # it renews its turn all the while
        with pytest.raises(LeaseHeld):
            with lease(spark, folder, seconds=0.6):
                pass
    create_once(spark, f"{lease_folder(folder)}/{9:012}", "died")
    touch(spark, f"{lease_folder(folder)}/{9:012}", time.time() - 100)
    with lease(spark, folder, seconds=60) as turn:
        assert turn.number == 10


def test_two_runs_at_once_give_the_rows_of_one(spark, bronze, paths):
    add(bronze(*[{"transaction_id": f"T{i}", "event_id": f"{i}"} for i in range(50)], at=FIRST), paths["bronze"])
    reports = []

    def run():
        with lease(spark, paths["silver"], wait=120) as turn:
            reports.append(run_silver(spark, paths["bronze"], paths["silver"], turn=turn).rows)

    run_all(spark, [run, run], 2)
    assert sorted(reports) == [0, 50]
    assert read_silver(spark, paths["silver"]).count() == 50


def test_an_overlapping_pipeline_is_refused(spark, bronze, paths):
    add(bronze({}, at=FIRST), paths["bronze"])
    run = lambda **more: run_pipeline(spark, paths["bronze"], paths["silver"], paths["gold"], wait=0, **more)
    with lease(spark, paths["silver"]):
        with pytest.raises(LeaseHeld):
            run()
    assert run()["gold_credit_risk"].count() == 1


def test_a_run_that_lost_its_turn_leaves_no_rows_and_no_mark(spark, bronze, paths):
    add(bronze({"event_id": "a"}, at=FIRST), paths["bronze"])
    run_silver(spark, paths["bronze"], paths["silver"])
    before = silver_mark(spark, paths["silver"])
    add(bronze({"event_id": "b"}, at=SECOND), paths["bronze"])
    with pytest.raises(LeaseLost):
        with lease(spark, paths["silver"]) as turn:
            create_once(spark, f"{lease_folder(paths['silver'])}/{turn.number + 1:012}", "another driver")
            run_silver(spark, paths["bronze"], paths["silver"], turn=turn)
    assert silver_mark(spark, paths["silver"]) == before
    assert [r.event_id for r in read_silver(spark, paths["silver"]).collect()] == ["a"]
    assert not [n for n in folder_names(spark, paths["silver"]) if n.startswith("_aside")]


def test_runs_with_a_turn_are_runs(spark, bronze, paths):
    for day, rows in ((FIRST, 1), (FIRST, 0), (SECOND, 1)):
        if rows:
            add(bronze({"event_id": day}, at=day), paths["bronze"])
        with lease(spark, paths["silver"]) as turn:
            assert run_silver(spark, paths["bronze"], paths["silver"], turn=turn).rows == rows
    assert sorted(r.event_id for r in read_silver(spark, paths["silver"]).collect()) == [FIRST, SECOND]


def test_of_two_notes_after_the_same_one_the_first_counts(spark, folder):
    journal = Journal(spark, folder)
    assert journal.last() == (0, None)
    assert journal.add(0, {"a": 1}) == 1
    with pytest.raises(RuntimeError):
        journal.add(0, {"a": 2})
    for number in range(1, 5):
        journal.add(number, {"a": number})
    assert journal.last() == (5, {"a": 4}) and len(names_in(spark, folder)) == 2

"""One job at a time on a table, and no late word from one that has lost its turn."""

from __future__ import annotations

import os
import socket
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tallyrock.sources.files import changed_at, create_once, exists, names_in, remove, touch

SECONDS = 60.0
RELEASED = ".released"


class LeaseHeld(RuntimeError):
    """Another job works on the table."""


class LeaseLost(RuntimeError):
    """Another job has taken over: this one was silent for too long."""


class Lease:
    """A turn on a table. Its number grows from turn to turn and fences off jobs of earlier turns."""

    def __init__(self, spark: SparkSession, folder: str, number: int):
        self.spark, self.folder, self.number = spark, folder, number

    def check(self) -> None:
        """To be called before anything becomes visible that counts, such as a mark."""
        newest = max(_turns(self.spark, self.folder), default=0)
        if newest != self.number:
            raise LeaseLost(f"turn {self.number} at {self.folder} was taken over by turn {newest}")

    def renew(self) -> None:
        touch(self.spark, _turn(self.folder, self.number), time.time())

    def release(self) -> None:
        create_once(self.spark, _turn(self.folder, self.number) + RELEASED)


def lease_folder(path: str) -> str:
    return f"{path.rstrip('/')}_lease"


def _turn(folder: str, number: int) -> str:
    return f"{folder}/{number:012}"


def _turns(spark: SparkSession, folder: str) -> list[int]:
    return [int(name) for name in names_in(spark, folder) if name.isdigit()]


def _is_free(spark: SparkSession, folder: str, number: int, seconds: float) -> bool:
    place = _turn(folder, number)
    return exists(spark, place + RELEASED) or time.time() - changed_at(spark, place) > seconds


@contextmanager
def lease(spark: SparkSession, path: str, seconds: float = SECONDS, wait: float = 0.0) -> Iterator[Lease]:
    """Holds the table at path; raises LeaseHeld if another job still does after `wait` seconds.

    A turn is a file that one of several callers can create. It is renewed while the block runs, so
    a job that died blocks the table for `seconds`, and one that hung longer than
    that finds its check failing. The clocks of the drivers and of the file system must agree to within a
    fraction of `seconds`.
    """
    folder, deadline = lease_folder(path), time.monotonic() + wait
    while True:
        newest = max(_turns(spark, folder), default=0)
        if newest == 0 or _is_free(spark, folder, newest, seconds):
            if create_once(spark, _turn(folder, newest + 1), f"{socket.gethostname()} {os.getpid()}\n"):
                held = Lease(spark, folder, newest + 1)
                break
            continue
        if time.monotonic() >= deadline:
            raise LeaseHeld(f"another job holds turn {newest} at {folder}")
        time.sleep(min(0.2, seconds / 4))
    for old in _turns(spark, folder):
        if old < held.number:
            remove(spark, _turn(folder, old))
            remove(spark, _turn(folder, old) + RELEASED)
    done = threading.Event()

    def keep() -> None:
        while not done.wait(seconds / 4):
            held.renew()

    keeper = threading.Thread(target=keep, daemon=True)
    keeper.start()
    try:
        yield held
    finally:
        done.set()
        keeper.join()
        held.release()

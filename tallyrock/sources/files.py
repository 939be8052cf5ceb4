"""Small files and folders on whatever file system a path names."""

from __future__ import annotations

import json
import os

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders right under a path; none if it does not exist."""
    files, place = _place(spark, path)
    return sorted(e.getPath().getName() for e in files.listStatus(place)) if files.exists(place) else []


def bytes_in(spark: SparkSession, path: str) -> int:
    files, place = _place(spark, path)
    return files.getContentSummary(place).getLength()


def changed_at(spark: SparkSession, path: str) -> float:
    """Seconds since the epoch."""
    files, place = _place(spark, path)
    return files.getFileStatus(place).getModificationTime() / 1000


def touch(spark: SparkSession, path: str, seconds: float) -> None:
    files, place = _place(spark, path)
    files.setTimes(place, int(seconds * 1000), -1)


def create_once(spark: SparkSession, path: str, text: str = "") -> bool:
    """Creates the file, unless it is there; of several callers at once one gets True.

    That holds on HDFS and local disks, whose creation is atomic, not on object stores that overwrite.
    """
    files, place = _place(spark, path)
    if files.getUri().getScheme() == "file":
        # Hadoop's local file system looks first and creates then, which two callers can do at once.
        local = place.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "x", encoding="utf-8") as file:
                file.write(text)
        except FileExistsError:
            return False
        return True
    try:
        stream = files.create(place, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    files, place = _place(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder; the target must not be there."""
    files, place = _place(spark, source)
    _, goal = _place(spark, target)
    if files.exists(goal) or not files.rename(place, goal):
        raise OSError(f"{source} could not be moved to {target}")


def remove(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


class Journal:
    """Numbered notes in a folder, of which the last whole one counts.

    A note is written by creating its file, so of two writers that follow the same note only one
    succeeds: the other has worked on an old state, and is told so.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _numbers(self) -> list[int]:
        return sorted(int(n) for n in names_in(self.spark, self.path) if n.isdigit())

    def last(self) -> tuple[int, dict | None]:
        """The number that the next note follows, and the last whole note."""
        numbers = self._numbers()
        for number in reversed(numbers):
            try:
                return numbers[-1], json.loads(read_text(self.spark, f"{self.path}/{number:012}"))
            except json.JSONDecodeError:  # its writer stopped half way
                continue
        return (numbers[-1] if numbers else 0), None

    def add(self, after: int, note: dict) -> int:
        number = after + 1
        if not create_once(self.spark, f"{self.path}/{number:012}", json.dumps(note)):
            raise RuntimeError(f"{self.path} has a note {number} already: another job changed the table")
        for old in self._numbers():
            if old < after:
                remove(self.spark, f"{self.path}/{old:012}")
        return number

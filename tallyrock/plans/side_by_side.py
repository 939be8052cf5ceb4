from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def run_all(spark: SparkSession, actions: Iterable[Callable], at_once: int) -> list:
    """Runs independent Spark actions from several threads and returns their results.

    Spark interleaves the tasks, so that small actions fill the gaps large ones
    leave. The first failure is raised after all have ended.
    """
    with ThreadPoolExecutor(at_once) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
    return [action.result() for action in started]

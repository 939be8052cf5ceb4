"""Batch table scans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tallyrock.sources.files import exists


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None
) -> DataFrame:
    """The whole table. A schema spares opening a file and allows a table without files."""
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    return reader.load(path)


def read_or_none(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None
) -> DataFrame | None:
    """The table, or None when the path does not exist. Any other failure is raised."""
    if fmt != "delta" and not any(c in path for c in "*?[{"):
        if not exists(spark, path):
            return None
    try:
        return read_table(spark, path, fmt, schema)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "DELTA_PATH_DOES_NOT_EXIST"):
            return None
        raise


def folder_names(spark: SparkSession, path: str) -> list[str] | None:
    """Names of the folders right under a path, None if it does not exist: one listing, no files."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return None
    return [entry.getPath().getName() for entry in files.listStatus(place) if entry.isDirectory()]


def read_folders(
    spark: SparkSession,
    path: str,
    column: str,
    wanted: Callable[[str], bool],
    fmt: str,
    schema: str,
) -> DataFrame:
    """Those partitions of a table whose value of the partition column, as text, is wanted.

    Only their folders are listed and opened. A table with a log of its own, delta or the
    output of a stream, is loaded through its log, which knows its files without a listing.
    """
    names = None if fmt == "delta" else folder_names(spark, path)
    start = f"{column}="
    if names is None or "_spark_metadata" in names or not any(n.startswith(start) for n in names):
        return read_table(spark, path, fmt, schema)
    chosen = [f"{path}/{n}" for n in sorted(names) if n.startswith(start) and wanted(n[len(start) :])]
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).option("basePath", path).load(chosen)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    return exists(spark, path)


def schema_of(df: DataFrame) -> str:
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in df.schema)

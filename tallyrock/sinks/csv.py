"""CSV extracts for a dashboard tool."""

from __future__ import annotations

from pyspark.sql import DataFrame


def export_csv(df: DataFrame, path: str, single_file: bool = False, compression: str = "none") -> None:
    """One folder of CSV with headers.

    Every task writes its own part file. single_file writes one part whatever the size, through
    one task: for datasets that a dashboard reads as one file. Packed with gzip, CSV takes a fifth
    of its room, and one task reads a part.
    """
    if single_file:
        df = df.repartition(1)
    df.write.mode("overwrite").option("header", True).option("compression", compression).csv(path)

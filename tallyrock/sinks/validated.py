"""Results of the quality rules as a table: accepted rows, and rejected rows with the rules they break.

One scan writes both into one batch, a folder each, which a repeated run replaces as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyrock.operators.quality import with_reject_reasons
from tallyrock.schema import BATCH_COLUMN, BRONZE_DDL
from tallyrock.sources.tables import read_or_none

VERDICT = "verdict"
ACCEPTED, REJECTED = "accepted", "rejected"
VALIDATED_DDL = f"{BRONZE_DDL}, reject_reasons ARRAY<STRING>"
VALIDATED_TABLE_DDL = f"{VALIDATED_DDL}, {BATCH_COLUMN} STRING, {VERDICT} STRING"


def write_validated(rows: DataFrame, path: str, batch_id: str, rules: Mapping[str, Column] | None = None, fmt: str = "parquet") -> None:
    """Writes every row, with its verdict, in place of what the batch held.

    No shuffle. The folder of the batch is replaced, not its two parts one by one, so a verdict that no row
    gets any more leaves nothing behind.
    """
    judged = with_reject_reasons(rows, rules)
    verdict = F.when(F.size("reject_reasons") > 0, REJECTED).otherwise(ACCEPTED)
    writer = judged.withColumn(VERDICT, verdict).write.format(fmt).mode("overwrite").partitionBy(VERDICT)
    writer.save(f"{path}/{BATCH_COLUMN}={batch_id}")


def read_validated(
    spark: SparkSession, path: str, verdict: str | None = None, batch_id: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """All rows judged, or those of a verdict or a batch, whose folders alone are read."""
    if batch_id is None:
        rows = read_or_none(spark, path, fmt, VALIDATED_TABLE_DDL)
    else:
        rows = read_or_none(spark, f"{path}/{BATCH_COLUMN}={batch_id}", fmt, f"{VALIDATED_DDL}, {VERDICT} STRING")
        rows = None if rows is None else rows.withColumn(BATCH_COLUMN, F.lit(batch_id))
    if rows is None:
        rows = spark.createDataFrame([], VALIDATED_TABLE_DDL)
    return rows if verdict is None else rows.filter(F.col(VERDICT) == verdict)


def validation_counts(validated: DataFrame) -> DataFrame:
    """Rows read, accepted and rejected per batch."""
    return validated.groupBy(BATCH_COLUMN).agg(
        F.count("*").alias("rows_read"),
        F.count_if(F.col(VERDICT) == ACCEPTED).alias("rows_accepted"),
        F.count_if(F.col(VERDICT) == REJECTED).alias("rows_rejected"),
    )


def rejections_by_rule(validated: DataFrame) -> DataFrame:
    """How many rows of each batch break each rule."""
    broken = validated.filter(F.col(VERDICT) == REJECTED).select(BATCH_COLUMN, F.explode("reject_reasons").alias("rule"))
    return broken.groupBy(BATCH_COLUMN, "rule").agg(F.count("*").alias("rows_rejected"))

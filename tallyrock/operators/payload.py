"""From message values to payload columns, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyrock.schema import PAYLOAD_DDL, SOURCE_LABEL

# Without this option JSON text leaves out NULL fields.
WITH_NULLS = {"ignoreNullFields": "false"}
WHITE_SPACE = " \t\n\x0b\f\r"


def decode(messages: DataFrame) -> DataFrame:
    """The message value as text; key, topic and offsets are not carried on."""
    return messages.select(F.col("value").cast("string").alias("value"))


def parse(messages: DataFrame, schema: str = PAYLOAD_DDL, keep_raw: bool = False) -> DataFrame:
    """One row per message with the payload fields as columns.

    A value that is no JSON object gives a row of NULLs; a field of the wrong
    type is NULL on its own; unknown fields are dropped. keep_raw adds the
    message text as raw_value.
    """
    parsed = decode(messages).select(F.from_json("value", schema).alias("data"), "value")
    return parsed.select("data.*", *([F.col("value").alias("raw_value")] if keep_raw else []))


def add_ingestion_metadata(df: DataFrame, source: str = SOURCE_LABEL) -> DataFrame:
    """Date and time of ingestion, constant within a micro-batch, and the source label."""
    return df.withColumns(
        {
            "ingestion_date": F.current_date(),
            "ingestion_time": F.current_timestamp(),
            "source": F.lit(source),
        }
    )


def to_messages(df: DataFrame, key: str = "account_id") -> DataFrame:
    """Rows as keyed JSON messages, NULL fields written out."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct("*"), WITH_NULLS).alias("value"),
    )


def lines_to_messages(lines: DataFrame, key: str = "account_id", strict: bool = False) -> DataFrame:
    """JSON lines as keyed messages, the text passed on whole with fields no schema knows.

    A missing or null key stays NULL, so that a message bus spreads such
    messages over its partitions. White space around a line is cut. strict fails
    the job on a line that is not one JSON object and nothing else. Other columns
    of lines are carried on.
    """
    # As the one element of an array, text after the object is an error to the parser too.
    whole = F.concat(F.lit("["), F.col("value"), F.lit("]"))
    options = {"columnNameOfCorruptRecord": "_broken"}
    data = F.from_json(whole, f"array<struct<`{key}`: string, _broken: string>>", options)
    # Most lines begin and end with a brace and have nothing to strip.
    bare = F.col("value").startswith("{") & F.col("value").endswith("}")
    stripped = F.when(bare, F.col("value")).otherwise(F.btrim("value", F.lit(WHITE_SPACE)))
    parsed = lines.withColumn("value", stripped).select("*", data.alias("list")).withColumn("data", F.get("list", F.lit(0)))
    message = F.col("value")
    if strict:
        one = (F.size("list") == 1) & F.col("data").isNotNull() & F.col("data._broken").isNull()
        broken = ~F.coalesce(one, F.lit(False)) | ~F.col("value").startswith("{")
        message = F.when(broken, F.raise_error(F.lit("not a JSON line"))).otherwise(message)
    others = [name for name in lines.columns if name != "value"]
    return parsed.select(F.col("data").getField(key).alias("key"), message.alias("value"), *others)

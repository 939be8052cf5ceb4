"""Every operator and job as a query from (session, folder of tables) to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry import jobs
from registry.jobs import PAYLOAD, ZONELESS, tie_breakers
from tallyrock.functions import calendar_parts, flag, is_high_value, is_suspicious, risk_score, to_time
from tallyrock.operators import dims, facts, kpi
from tallyrock.operators.dedup import latest_per_key
from tallyrock.operators.enrich import enrich, normalize
from tallyrock.operators.incremental import high_water_mark, new_since
from tallyrock.operators.payload import add_ingestion_metadata, decode, parse, to_messages
from tallyrock.operators.quality import (
    accepted,
    duplicate_groups,
    quality_report,
    quality_rules,
    split_valid,
)
from tallyrock.plans.silver import silver_increment
from tallyrock.schema import LOWER_CASE_COLUMNS, PAYLOAD_FIELDS, UPPER_CASE_COLUMNS
from tallyrock.sources.star_schema import table, transactions

Query = Callable[[SparkSession, str], DataFrame]

def silver(spark: SparkSession, folder: str, **options) -> DataFrame:
    options = {"time_kind": ZONELESS, "tie_breakers": tie_breakers()} | options
    return silver_increment(transactions(spark, folder), **options)


def on_bronze(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: step(transactions(spark, folder))


def on_silver(step: Callable[[DataFrame], DataFrame], **options) -> Query:
    return lambda spark, folder: step(silver(spark, folder, **options))


# --- payloads -----------------------------------------------------------------


def parse_json_payload(spark: SparkSession, folder: str) -> DataFrame:
    """The library's parser on the JSON that the events carry."""
    events = table(spark, folder, "events")
    with_id = F.concat(F.lit('{"event_id":'), F.col("event_id"), F.lit(","), F.substring("props", 2, 1 << 30))
    return parse(events.select(with_id.alias("value")), "event_id BIGINT, k INT")


def payload_messages(bronze: DataFrame) -> DataFrame:
    return to_messages(bronze.select(*PAYLOAD))


def decode_payload(bronze: DataFrame) -> DataFrame:
    binary = payload_messages(bronze).select(F.col("value").cast("binary").alias("value"))
    return decode(binary).select(F.get_json_object("value", "$.event_id").alias("event_id"))


def keyed_messages(bronze: DataFrame) -> DataFrame:
    fields = payload_messages(bronze).select("key", F.json_tuple("value", *PAYLOAD).alias(*PAYLOAD))
    return fields.select("key", *[F.col(name).cast(kind) for name, kind in PAYLOAD_FIELDS])


def ingestion_label(bronze: DataFrame) -> DataFrame:
    stamped = add_ingestion_metadata(bronze.select("event_id"))
    return stamped.select(
        "event_id",
        "source",
        (F.to_date("ingestion_time") == F.col("ingestion_date")).alias("date_matches"),
    )


# --- rules --------------------------------------------------------------------


def filter_by(rule: str) -> Query:
    return on_bronze(
        lambda bronze: accepted(bronze, {rule: quality_rules()[rule]}).select(*PAYLOAD)
    )


def strict_filter(bronze: DataFrame) -> DataFrame:
    return accepted(bronze, quality_rules(strict_amount=True, strict_dates=True)).select(*PAYLOAD)


def finite_amounts(bronze: DataFrame) -> DataFrame:
    """Events that the strict amount rule accepts, where some amounts are NaN or infinite."""
    odd = F.when(F.col("event_id").endswith("7"), float("nan")).when(F.col("event_id").endswith("13"), float("inf"))
    rows = bronze.withColumn("txn_amount", F.coalesce(odd, F.col("txn_amount")))
    return accepted(rows, quality_rules(strict_amount=True)).select("event_id")


def whole_amounts(rows: DataFrame) -> DataFrame:
    """Amounts without cents: their double sums are the same in any order."""
    return rows.withColumn("txn_amount", F.floor("txn_amount").cast("double"))


def incremental_filter(bronze: DataFrame) -> DataFrame:
    mark = F.lit("2000-01-01 00:00:00").cast(ZONELESS)
    return new_since(bronze, mark, date_column="ingestion_date").select("event_id", "ingestion_time")


def rejected_reasons(bronze: DataFrame) -> DataFrame:
    _, rejected = split_valid(bronze)
    return rejected.select("event_id", F.array_join("reject_reasons", ",").alias("reasons"))


# --- columns ------------------------------------------------------------------


def normalize_text(bronze: DataFrame) -> DataFrame:
    return normalize(bronze.select("event_id", *LOWER_CASE_COLUMNS, *UPPER_CASE_COLUMNS))


def parse_timestamps(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "event_id",
        to_time("txn_date", ZONELESS).alias("txn_ts"),
        to_time("settlement_date", ZONELESS).alias("settlement_ts"),
    )


def calendar_columns(bronze: DataFrame) -> DataFrame:
    days = bronze.select("event_id", F.to_date(to_time("txn_date", ZONELESS)).alias("txn_date_only"))
    return days.withColumns(calendar_parts("txn_date_only"))


def enriched(*columns: str) -> Query:
    return on_bronze(lambda bronze: enrich(bronze, time_kind=ZONELESS).select("event_id", *columns))


def status_flags(bronze: DataFrame) -> DataFrame:
    return enrich(bronze, time_kind=ZONELESS).select(
        "event_id", "txn_status", "is_settled", "high_value_flag"
    )


def suspicious_flags(bronze: DataFrame) -> DataFrame:
    return normalize(enrich(bronze, time_kind=ZONELESS)).select(
        "event_id", "txn_hour", "country_code", flag(is_suspicious()).alias("suspicious")
    )


def account_scores(bronze: DataFrame) -> DataFrame:
    counts = bronze.groupBy("account_id").agg(
        F.count("*").alias("txn_count"), F.sum(flag(is_high_value())).alias("high_value_txns")
    )
    return counts.select("account_id", risk_score().alias("risk_score"))


# --- keys ---------------------------------------------------------------------


def latest_per_transaction(bronze: DataFrame) -> DataFrame:
    return latest_per_key(bronze.dropna(subset=["transaction_id"]), tie_breakers=tie_breakers())


def row_count(bronze: DataFrame) -> DataFrame:
    return bronze.agg(F.count("*").alias("row_count"))


ALL_QUERIES: dict[str, Query] = {
    "parse_json_payload": parse_json_payload,
    "json_round_trip": on_bronze(lambda bronze: parse(payload_messages(bronze))),
    "decode_payload": on_bronze(decode_payload),
    "keyed_messages": on_bronze(keyed_messages),
    "ingestion_label": on_bronze(ingestion_label),
    "filter_f1": filter_by("transaction_id_present"),
    "filter_f2": filter_by("account_id_present"),
    "filter_f3": filter_by("customer_id_present"),
    "filter_f4": filter_by("txn_amount_present"),
    "filter_f5": filter_by("txn_amount_positive"),
    "filter_f6": filter_by("txn_date_present"),
    "filter_all": on_bronze(lambda bronze: accepted(bronze).select(*PAYLOAD)),
    "filter_strict": on_bronze(strict_filter),
    "filter_finite": on_bronze(finite_amounts),
    "incremental_filter": on_bronze(incremental_filter),
    "quality_report": on_bronze(quality_report),
    "rejected_reasons": on_bronze(rejected_reasons),
    "duplicate_groups": on_bronze(duplicate_groups),
    "normalize_text": on_bronze(normalize_text),
    "parse_timestamps": on_bronze(parse_timestamps),
    "calendar_parts": on_bronze(calendar_columns),
    "txn_hour": enriched("txn_hour"),
    "days_to_settle": enriched("txn_ts", "settlement_ts", "days_to_settle"),
    "status_flags": on_bronze(status_flags),
    "suspicious_flags": on_bronze(suspicious_flags),
    "risk_score": on_bronze(account_scores),
    "row_count": on_bronze(row_count),
    "high_water_mark": on_bronze(high_water_mark),
    "latest_per_transaction": on_bronze(latest_per_transaction),
    "silver": silver,
    "silver_normalized_first": partial(silver, normalize_first=True),
    "silver_strict": partial(silver, strict_amount=True, strict_dates=True),
    "lifecycle_fact": on_silver(facts.lifecycle_fact),
    "fraud_fact": on_silver(facts.fraud_fact),
    "credit_risk_fact": on_silver(partial(facts.credit_risk_fact, exact=True)),
    "daily_summary": on_silver(partial(facts.daily_summary, exact=True)),
    "credit_risk_double": on_silver(lambda rows: facts.credit_risk_fact(whole_amounts(rows))),
    "daily_summary_double": on_silver(lambda rows: facts.daily_summary(whole_amounts(rows))),
    "dim_date": on_silver(dims.dim_date),
    **{name: on_silver(partial(dims.dim, key=key)) for name, key in dims.KEY_DIMENSIONS.items()},
    "kpi_totals": on_silver(partial(kpi.totals, exact=True)),
    "kpi_status": on_silver(kpi.by_status),
    "kpi_settlement": on_silver(kpi.settlement_by_status),
    "kpi_settlement_rate": on_silver(kpi.settlement_rate),
    "kpi_fraud": on_silver(lambda rows: kpi.by_fraud_flag(facts.fraud_fact(rows), exact=True)),
    "kpi_high_value": on_silver(partial(kpi.high_value_volume, exact=True)),
    "kpi_risk_trend": on_silver(kpi.risk_trend),
    "kpi_daily": on_silver(partial(facts.daily_summary, exact=True)),
    "kpi_channel": on_silver(partial(kpi.by_channel, exact=True)),
    "kpi_merchant": on_silver(partial(kpi.by_merchant, exact=True)),
    **jobs.ALL_JOBS,
}

"""SQL for DuckDB, one text per query, on the same Parquet tables."""

from __future__ import annotations

from tallyrock.schema import BRONZE_FIELDS, PAYLOAD_FIELDS, SILVER_FIELDS, names
from tallyrock.sources.star_schema import EVENT_COLUMNS

PAYLOAD = ", ".join(names(PAYLOAD_FIELDS))
BRONZE = ", ".join(names(BRONZE_FIELDS))
SILVER = ", ".join(names(SILVER_FIELDS))

RAW_CTE = (
    "raw AS (SELECT "
    + ", ".join(f"{sql} AS {name}" for name, sql in EVENT_COLUMNS.items())
    + """
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
 JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)"""
)

ACCEPTED = (
    "transaction_id IS NOT NULL AND account_id IS NOT NULL AND customer_id IS NOT NULL"
    " AND txn_amount IS NOT NULL AND txn_amount > 0 AND txn_date IS NOT NULL"
)
STRICT = (
    f"{ACCEPTED} AND NOT isnan(txn_amount) AND txn_amount <> CAST('inf' AS DOUBLE)"
    " AND TRY_CAST(txn_date AS TIMESTAMP) IS NOT NULL"
)
NEWEST_FIRST = (
    "ingestion_time DESC NULLS LAST, TRY_CAST(ingest_ts AS TIMESTAMP) DESC NULLS LAST,"
    " event_id DESC NULLS LAST, txn_amount DESC NULLS LAST"
)
TIMED = (
    "SELECT *, TRY_CAST(txn_date AS TIMESTAMP) AS txn_ts,"
    " TRY_CAST(settlement_date AS TIMESTAMP) AS settlement_ts FROM raw"
)
SETTLED = "CASE WHEN txn_status = 'settled' THEN 1 ELSE 0 END"
SETTLED_CLEAN = "CASE WHEN lower(trim(txn_status)) = 'settled' THEN 1 ELSE 0 END"
HIGH_VALUE = "CASE WHEN txn_amount > 10000 THEN 1 ELSE 0 END"
DAYS = "CAST(date_diff('day', txn_ts, settlement_ts) AS INT)"
CLEAN_COLUMNS = """lower(trim(txn_type)) AS txn_type, lower(trim(txn_status)) AS txn_status,
 lower(trim(channel)) AS channel, lower(trim(merchant_category)) AS merchant_category,
 upper(trim(currency)) AS currency, upper(trim(country_code)) AS country_code,
 lower(trim(credit_risk)) AS credit_risk"""
SUSPICIOUS = (
    "CASE WHEN txn_amount > 10000 OR txn_hour BETWEEN 0 AND 4 OR country_code <> 'US'"
    " THEN 1 ELSE 0 END"
)
EXACT_SUM = "CAST(sum(CAST(txn_amount AS DECIMAL(18,2))) AS DOUBLE)"
WHOLE_SUM = "sum(floor(txn_amount))"
EXACT_AVG = f"{EXACT_SUM} / count(txn_amount)"
SCORE = "CAST(sum(high_value_flag) AS BIGINT) * 2 + count(*) * CAST(0.1 AS DOUBLE)"


def silver_cte(rule: str = ACCEPTED, settled: str = SETTLED, per: str = "transaction_id") -> str:
    return f"""clean AS (SELECT * FROM (SELECT event_id, ingest_ts, source_system, transaction_id,
 account_id, customer_id, txn_date, txn_amount, settlement_date, account_balance, fraud_flag,
 ingestion_date, ingestion_time, source, {CLEAN_COLUMNS}, txn_ts, settlement_ts,
 CAST(txn_ts AS DATE) AS txn_date_only, CAST(hour(txn_ts) AS INT) AS txn_hour,
 {DAYS} AS days_to_settle, {settled} AS is_settled, {HIGH_VALUE} AS high_value_flag,
 row_number() OVER (PARTITION BY {per} ORDER BY {NEWEST_FIRST}) AS position
 FROM ({TIMED} WHERE {rule}) timed) ranked WHERE position = 1)"""


def on_raw(select: str) -> str:
    return f"WITH {RAW_CTE} {select}"


def on_silver(select: str, **options) -> str:
    return f"WITH {RAW_CTE}, {silver_cte(**options)} {select}"


def filtered(rule: str) -> str:
    return on_raw(f"SELECT {PAYLOAD} FROM raw WHERE {rule}")


RULES = {
    "transaction_id_present": "transaction_id IS NOT NULL",
    "account_id_present": "account_id IS NOT NULL",
    "customer_id_present": "customer_id IS NOT NULL",
    "txn_amount_present": "txn_amount IS NOT NULL",
    "txn_amount_positive": "coalesce(txn_amount > 0, false)",
    "txn_date_present": "txn_date IS NOT NULL",
}

QUALITY_REPORT = (
    "SELECT count(*) AS total_rows, "
    + ", ".join(
        f"CAST(sum(CASE WHEN {rule} THEN 0 ELSE 1 END) AS BIGINT) AS failed_{name}"
        for name, rule in RULES.items()
    )
    + f", CAST(sum(CASE WHEN {ACCEPTED} THEN 1 ELSE 0 END) AS BIGINT) AS accepted_rows FROM raw"
)
REASONS = (
    "concat_ws(',', "
    + ", ".join(f"CASE WHEN {rule} THEN NULL ELSE '{name}' END" for name, rule in RULES.items())
    + ")"
)

LIFECYCLE = """SELECT transaction_id, account_id, customer_id, txn_ts AS txn_date, txn_amount,
 txn_status, settlement_ts AS settlement_date, days_to_settle, is_settled, high_value_flag FROM clean"""
FRAUD = f"""SELECT transaction_id, account_id, txn_amount, txn_hour, country_code, channel,
 {SUSPICIOUS} AS fraud_flag FROM clean"""
CREDIT_RISK = f"""SELECT account_id, {EXACT_SUM} AS total_spend, {EXACT_AVG} AS avg_txn,
 count(*) AS txn_count, CAST(sum(high_value_flag) AS BIGINT) AS high_value_txns,
 {SCORE} AS risk_score FROM clean GROUP BY account_id"""
DAILY = f"""SELECT txn_date_only, count(*) AS total_txns, {EXACT_SUM} AS total_amount,
 {EXACT_AVG} AS avg_amount, CAST(sum(is_settled) AS BIGINT) AS settled_txns
 FROM clean GROUP BY txn_date_only"""
CALENDAR = """CAST(year({0}) AS INT) AS year, CAST(month({0}) AS INT) AS month,
 CAST(day({0}) AS INT) AS day, CAST(weekofyear({0}) AS INT) AS week"""
DIM_DATE = f"""SELECT d AS date, {CALENDAR.format('d')}
 FROM (SELECT DISTINCT txn_date_only AS d FROM clean) days"""
VOLUME = f"count(*) AS transactions, {EXACT_SUM} AS amount"

# Dimension to key.
DIMENSIONS = {
    "dim_account": "account_id",
    "dim_customer": "customer_id",
    "dim_transaction_type": "txn_type",
    "dim_channel": "channel",
    "dim_country": "country_code",
    "dim_merchant": "merchant_category",
}
GOLD = {
    "gold_transaction_lifecycle": LIFECYCLE,
    "gold_fraud_detection": FRAUD,
    "gold_credit_risk": CREDIT_RISK,
    "gold_transaction_summary": DAILY,
    "dim_date": DIM_DATE,
    **{name: f"SELECT DISTINCT {key} FROM clean" for name, key in DIMENSIONS.items()},
}
# CSV does not tell NULL from empty text, and a blank line is no row.
CSV = (
    GOLD
    | {
        "gold_fraud_detection": "SELECT * REPLACE (coalesce(country_code, '') AS country_code,"
        f" coalesce(channel, '') AS channel) FROM ({FRAUD}) f",
        "dim_date": f"SELECT * FROM ({DIM_DATE}) d WHERE date IS NOT NULL",
    }
    | {name: f"SELECT DISTINCT {key} FROM clean WHERE {key} <> ''" for name, key in DIMENSIONS.items()}
)
TABLE_SIZES = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM ({select}) t"
    for name, select in GOLD.items()
)

# Increments as the jobs cut them, by the date of ingestion.
INCREMENT = (
    "CASE WHEN ingestion_date < DATE '1995-01-01' THEN 1 WHEN ingestion_date < DATE '1998-01-01'"
    " THEN 2 WHEN ingestion_date < DATE '2000-01-01' THEN 3 ELSE 4 END"
)
PER_INCREMENT = f"transaction_id, {INCREMENT}"

RUNS = f"SELECT transaction_id, {INCREMENT} AS run FROM clean"
VERDICT = f"CASE WHEN coalesce({ACCEPTED}, false) THEN 'accepted' ELSE 'rejected' END"

STAMPS = ("ingestion_date", "ingestion_time")
SILVER_UNSTAMPED = ", ".join(name for name in names(SILVER_FIELDS) if name not in STAMPS)

ALL_ORACLES: dict[str, str] = {
    "parse_json_payload": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
    "json_round_trip": on_raw(f"SELECT {PAYLOAD} FROM raw"),
    "decode_payload": on_raw("SELECT event_id FROM raw"),
    "keyed_messages": on_raw(f"SELECT account_id AS key, {PAYLOAD} FROM raw"),
    "ingestion_label": on_raw("SELECT event_id, source, true AS date_matches FROM raw"),
    "filter_f1": filtered("transaction_id IS NOT NULL"),
    "filter_f2": filtered("account_id IS NOT NULL"),
    "filter_f3": filtered("customer_id IS NOT NULL"),
    "filter_f4": filtered("txn_amount IS NOT NULL"),
    "filter_f5": filtered("txn_amount > 0"),
    "filter_f6": filtered("txn_date IS NOT NULL"),
    "filter_all": filtered(ACCEPTED),
    "filter_strict": filtered(STRICT),
    "filter_finite": on_raw(
        f"SELECT event_id FROM raw WHERE {ACCEPTED} AND NOT (event_id LIKE '%7' OR event_id LIKE '%13')"
    ),
    "incremental_filter": on_raw(
        "SELECT event_id, ingestion_time FROM raw WHERE ingestion_time > TIMESTAMP '2000-01-01 00:00:00'"
    ),
    "quality_report": on_raw(QUALITY_REPORT),
    "rejected_reasons": on_raw(
        f"SELECT event_id, {REASONS} AS reasons FROM raw WHERE NOT coalesce({ACCEPTED}, false)"
    ),
    "duplicate_groups": on_raw(
        "SELECT transaction_id, count(*) AS copies FROM raw WHERE transaction_id IS NOT NULL"
        " GROUP BY transaction_id HAVING count(*) > 1"
    ),
    "normalize_text": on_raw(f"SELECT event_id, {CLEAN_COLUMNS} FROM raw"),
    "parse_timestamps": on_raw(f"SELECT event_id, txn_ts, settlement_ts FROM ({TIMED}) t"),
    "calendar_parts": on_raw(
        f"SELECT event_id, txn_date_only, {CALENDAR.format('txn_date_only')} FROM"
        f" (SELECT event_id, CAST(txn_ts AS DATE) AS txn_date_only FROM ({TIMED}) t) d"
    ),
    "txn_hour": on_raw(f"SELECT event_id, CAST(hour(txn_ts) AS INT) AS txn_hour FROM ({TIMED}) t"),
    "days_to_settle": on_raw(
        f"SELECT event_id, txn_ts, settlement_ts, {DAYS} AS days_to_settle FROM ({TIMED}) t"
    ),
    "status_flags": on_raw(
        f"SELECT event_id, txn_status, {SETTLED} AS is_settled, {HIGH_VALUE} AS high_value_flag FROM raw"
    ),
    "suspicious_flags": on_raw(
        f"SELECT event_id, txn_hour, country_code, {SUSPICIOUS} AS suspicious FROM (SELECT event_id,"
        " txn_amount, CAST(hour(txn_ts) AS INT) AS txn_hour, upper(trim(country_code)) AS country_code"
        f" FROM ({TIMED}) t) c"
    ),
    "risk_score": on_raw(
        f"SELECT account_id, CAST(sum({HIGH_VALUE}) AS BIGINT) * 2 + count(*) * CAST(0.1 AS DOUBLE)"
        " AS risk_score FROM raw GROUP BY account_id"
    ),
    "row_count": on_raw("SELECT count(*) AS row_count FROM raw"),
    "high_water_mark": on_raw("SELECT max(ingestion_time) AS high_water_mark FROM raw"),
    "latest_per_transaction": on_raw(
        f"SELECT {BRONZE} FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id"
        f" ORDER BY {NEWEST_FIRST}) AS position FROM raw WHERE transaction_id IS NOT NULL) r"
        " WHERE position = 1"
    ),
    "silver": on_silver(f"SELECT {SILVER} FROM clean"),
    "silver_normalized_first": on_silver(f"SELECT {SILVER} FROM clean", settled=SETTLED_CLEAN),
    "silver_strict": on_silver(f"SELECT {SILVER} FROM clean", rule=STRICT),
    "lifecycle_fact": on_silver(LIFECYCLE),
    "fraud_fact": on_silver(FRAUD),
    "credit_risk_fact": on_silver(CREDIT_RISK),
    "daily_summary": on_silver(DAILY),
    "credit_risk_double": on_silver(CREDIT_RISK.replace(EXACT_SUM, WHOLE_SUM)),
    "daily_summary_double": on_silver(DAILY.replace(EXACT_SUM, WHOLE_SUM)),
    "dim_date": on_silver(DIM_DATE),
    **{name: on_silver(f"SELECT DISTINCT {key} FROM clean") for name, key in DIMENSIONS.items()},
    "kpi_totals": on_silver(
        f"SELECT count(*) AS total_transactions, {EXACT_SUM} AS total_amount,"
        f" {EXACT_AVG} AS average_amount FROM clean"
    ),
    "kpi_status": on_silver(
        "SELECT txn_status, count(*) AS transactions FROM clean GROUP BY txn_status"
    ),
    "kpi_settlement": on_silver(
        "SELECT txn_status, count(*) AS transactions, count(settlement_ts) AS with_settlement,"
        " CAST(sum(days_to_settle) AS DOUBLE) / count(days_to_settle) AS avg_days,"
        " min(days_to_settle) AS min_days, max(days_to_settle) AS max_days"
        " FROM clean GROUP BY txn_status"
    ),
    "kpi_settlement_rate": on_silver(
        "SELECT CAST(sum(is_settled) AS BIGINT) AS settled_transactions,"
        " CAST(sum(is_settled) AS DOUBLE) / count(*) AS settled_rate FROM clean"
    ),
    "kpi_fraud": on_silver(
        f"SELECT fraud_flag, {VOLUME} FROM (SELECT txn_amount, {SUSPICIOUS} AS fraud_flag FROM clean) f"
        " GROUP BY fraud_flag"
    ),
    "kpi_high_value": on_silver(f"SELECT {VOLUME} FROM clean WHERE high_value_flag = 1"),
    "kpi_risk_trend": on_silver(
        "SELECT account_id, CAST(date_trunc('month', txn_date_only) AS DATE) AS month,"
        " count(*) AS txn_count, CAST(sum(high_value_flag) AS BIGINT) AS high_value_txns,"
        f" {SCORE} AS risk_score FROM clean GROUP BY ALL"
    ),
    "kpi_daily": on_silver(DAILY),
    "kpi_channel": on_silver(f"SELECT channel, {VOLUME} FROM clean GROUP BY channel"),
    "kpi_merchant": on_silver(
        f"SELECT merchant_category, {VOLUME} FROM clean GROUP BY merchant_category"
    ),
    # jobs
    "table_scan": on_raw(f"SELECT {BRONZE} FROM raw"),
    "append_then_overwrite": on_raw(f"SELECT {PAYLOAD} FROM raw"),
    "ndjson_scan": on_raw(f"SELECT {PAYLOAD} FROM raw"),
    "publish_progress": on_raw("SELECT count(*) AS records FROM raw"),
    "csv_round_trip": on_silver(LIFECYCLE),
    "bronze_stream": on_raw(f"SELECT {PAYLOAD}, source FROM raw"),
    "bronze_stream_progress": on_raw("SELECT count(*) AS records FROM raw"),
    "silver_stream": on_silver(f"SELECT {SILVER_UNSTAMPED} FROM clean"),
    "silver_replay": on_silver(f"SELECT {SILVER} FROM clean"),
    "run_report": on_silver(
        "SELECT 'first' AS run, count(*) AS row_count, least(count(*), 5) AS previewed FROM clean"
        " UNION ALL SELECT 'second', CAST(0 AS BIGINT), CAST(0 AS BIGINT)"
    ),
    "silver_increments": on_silver(f"SELECT {SILVER} FROM clean", per=PER_INCREMENT),
    "silver_current": on_silver(f"SELECT {SILVER} FROM clean"),
    "silver_current_merged": on_silver(f"SELECT {SILVER} FROM clean"),
    "silver_compacted": on_silver(f"SELECT {SILVER} FROM clean", per=PER_INCREMENT),
    "silver_two_at_once": on_silver(f"SELECT {SILVER} FROM clean"),
    "silver_validated": on_silver(f"SELECT {SILVER} FROM clean", per=PER_INCREMENT),
    "repeated_transactions": on_silver(
        f"SELECT later.transaction_id, later.run, earlier.run AS earlier_run FROM ({RUNS}) later"
        f" JOIN ({RUNS}) earlier ON later.transaction_id = earlier.transaction_id AND earlier.run < later.run",
        per=PER_INCREMENT,
    ),
    "validation_results": on_raw(
        f"SELECT event_id, {VERDICT} AS verdict, {REASONS} AS reasons, {INCREMENT} AS run FROM raw"
    ),
    "validation_summary": on_raw(
        "SELECT run, count(*) AS rows_read, count(*) FILTER (verdict = 'accepted') AS rows_accepted,"
        f" count(*) FILTER (verdict = 'rejected') AS rows_rejected FROM (SELECT {VERDICT} AS verdict,"
        f" {INCREMENT} AS run FROM raw) judged GROUP BY run"
    ),
    "gold_late_credit_risk": on_silver(CREDIT_RISK, per=PER_INCREMENT),
    "gold_late_lifecycle": on_silver(LIFECYCLE, per=PER_INCREMENT),
    "bronze_stream_metrics": on_raw(
        "SELECT count(*) AS records, count(*) FILTER (transaction_id IS NULL) AS without_id, true AS many_batches FROM raw"
    ),
    "published_by_account": on_raw(
        "SELECT account_id AS key, count(*) AS messages, CAST(1 AS BIGINT) AS files,"
        " CAST(0 AS BIGINT) AS out_of_order FROM raw WHERE account_id IS NOT NULL GROUP BY account_id"
    ),
    "pipeline_twice": on_silver(f"SELECT {SILVER} FROM clean"),
    "pipeline_gold": on_silver(DAILY),
    "gold_refresh": on_silver(TABLE_SIZES),
    **{f"refreshed_{name}": on_silver(select) for name, select in GOLD.items()},
    **{f"csv_{name}": on_silver(select) for name, select in CSV.items()},
    "gold_refresh_increments": on_silver(CREDIT_RISK, per=PER_INCREMENT),
    "gold_refresh_current": on_silver(CREDIT_RISK),
    "gold_totals_credit_risk": on_silver(CREDIT_RISK, per=PER_INCREMENT),
    "gold_totals_summary": on_silver(DAILY, per=PER_INCREMENT),
    "gold_totals_lifecycle": on_silver(LIFECYCLE, per=PER_INCREMENT),
    "gold_totals_customers": on_silver("SELECT DISTINCT customer_id FROM clean", per=PER_INCREMENT),
    "gold_totals_merchants": on_silver(
        "SELECT DISTINCT merchant_category FROM clean", per=PER_INCREMENT
    ),
    "gold_totals_fraud": on_silver(FRAUD, per=PER_INCREMENT),
    "gold_totals_dates": on_silver(DIM_DATE, per=PER_INCREMENT),
    "gold_totals_accounts": on_silver(GOLD["dim_account"], per=PER_INCREMENT),
    "gold_totals_types": on_silver(GOLD["dim_transaction_type"], per=PER_INCREMENT),
    "gold_totals_channels": on_silver(GOLD["dim_channel"], per=PER_INCREMENT),
    "gold_totals_countries": on_silver(GOLD["dim_country"], per=PER_INCREMENT),
}
ALL_ORACLES |= {f"dashboard_{name}": sql for name, sql in ALL_ORACLES.items() if name.startswith("kpi_")}

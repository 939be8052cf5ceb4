"""Column layouts of the three layers, and the values the rules are built on."""

# The event payload, field by field, as the message source sends it.
PAYLOAD_FIELDS = (
    ("event_id", "STRING"),
    ("ingest_ts", "STRING"),
    ("source_system", "STRING"),
    ("transaction_id", "STRING"),
    ("account_id", "STRING"),
    ("customer_id", "STRING"),
    ("txn_date", "STRING"),
    ("txn_type", "STRING"),
    ("txn_amount", "DOUBLE"),
    ("txn_status", "STRING"),
    ("settlement_date", "STRING"),
    ("account_balance", "DOUBLE"),
    ("fraud_flag", "BOOLEAN"),
    ("credit_risk", "STRING"),
    ("channel", "STRING"),
    ("merchant_category", "STRING"),
    ("currency", "STRING"),
    ("country_code", "STRING"),
)

# What ingestion adds to the payload.
INGESTION_FIELDS = (
    ("ingestion_date", "DATE"),
    ("ingestion_time", "TIMESTAMP"),
    ("source", "STRING"),
)

# What Silver adds to Bronze.
SETTLEMENT_FIELDS = (
    ("txn_ts", "TIMESTAMP"),
    ("settlement_ts", "TIMESTAMP"),
    ("txn_date_only", "DATE"),
    ("txn_hour", "INT"),
    ("days_to_settle", "INT"),
    ("is_settled", "INT"),
    ("high_value_flag", "INT"),
)

BRONZE_FIELDS = PAYLOAD_FIELDS + INGESTION_FIELDS
SILVER_FIELDS = BRONZE_FIELDS + SETTLEMENT_FIELDS

# The columns of the two row-level facts, by their names in Silver.
LIFECYCLE_COLUMNS = (
    "transaction_id",
    "account_id",
    "customer_id",
    "txn_ts",
    "txn_amount",
    "txn_status",
    "settlement_ts",
    "days_to_settle",
    "is_settled",
    "high_value_flag",
)
FRAUD_COLUMNS = (
    "transaction_id",
    "account_id",
    "txn_amount",
    "txn_hour",
    "country_code",
    "channel",
)

# Rule thresholds, labels and defaults.
HIGH_VALUE_THRESHOLD = 10000.0
NIGHT_HOURS = (0, 4)
HOME_COUNTRY = "US"
SETTLED_STATUS = "settled"
HIGH_VALUE_WEIGHT = 2
TRANSACTION_WEIGHT = 0.1
SOURCE_LABEL = "kafka_txn_stream"
TOPIC = "txn"
BROKERS = "kafka:9092"
MICRO_BATCH_INTERVAL = "30 seconds"

# The columns whose text is cleaned, by target case.
LOWER_CASE_COLUMNS = ("txn_type", "txn_status", "channel", "merchant_category", "credit_risk")
UPPER_CASE_COLUMNS = ("currency", "country_code")

# Silver and the per-batch Gold pieces are laid out by this column, so that a
# repeated batch replaces its own files and nothing else.
BATCH_COLUMN = "batch_id"


def names(fields) -> list[str]:
    return [name for name, _ in fields]


def ddl(fields) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields)


PAYLOAD_DDL = ddl(PAYLOAD_FIELDS)
BRONZE_DDL = ddl(BRONZE_FIELDS)
SILVER_DDL = ddl(SILVER_FIELDS)
SILVER_TABLE_DDL = f"{SILVER_DDL}, {BATCH_COLUMN} STRING"

"""The star-schema Parquet tables seen as transaction events.

Every line item becomes one event. Some keys, amounts and dates are missing,
negative or unreadable and some texts padded on purpose, so that each quality
rule and each cleaning step has work to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyrock.schema import BRONZE_FIELDS, SOURCE_LABEL

SOURCE_SYSTEM = "star_schema_tables"

# The layout of the tables. With it Spark need not open a file to plan.
TABLES = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,"
    " l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,"
    " c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,"
    " p_retailprice DOUBLE",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,"
    " value DOUBLE, props STRING",
}

# Column to SQL text that reads the same in Spark and in other ANSI engines.
EVENT_COLUMNS = {
    "event_id": "CAST(l_orderkey AS STRING)||'-'||CAST(l_linenumber AS STRING)"
    "||'-'||CAST(l_partkey AS STRING)||'-'||CAST(l_suppkey AS STRING)",
    "ingest_ts": "CAST(l_shipdate AS STRING)",
    "source_system": f"'{SOURCE_SYSTEM}'",
    "transaction_id": "CASE WHEN l_partkey % 101 = 0 THEN NULL"
    " ELSE 'TXN'||CAST(l_orderkey AS STRING)||'-'||CAST(l_linenumber AS STRING) END",
    # Two accounts a customer. The padding never shortens a longer key.
    "account_id": "CASE WHEN l_suppkey % 89 = 0 THEN NULL"
    " ELSE 'ACCT'||lpad(CAST(o_custkey AS STRING),"
    "CAST(greatest(8,length(CAST(o_custkey AS STRING))) AS INT),'0') END",
    "customer_id": "CASE WHEN l_suppkey % 83 = 0 THEN NULL"
    " ELSE 'CUST'||CAST(o_custkey - o_custkey % 2 AS STRING) END",
    "txn_date": "CASE WHEN l_partkey % 103 = 0 THEN NULL WHEN l_partkey % 107 = 0 THEN 'n/a'"
    " ELSE CAST(o_orderdate + CAST(l_partkey % 24 AS INT) * INTERVAL '1' HOUR AS STRING) END",
    "txn_type": "CASE WHEN l_linestatus = 'F' THEN ' Debit ' ELSE 'CREDIT' END",
    "txn_amount": "CASE WHEN l_partkey % 97 = 0 THEN NULL"
    " WHEN l_quantity = 1 THEN -l_extendedprice ELSE l_extendedprice END",
    "txn_status": "CASE WHEN l_returnflag = 'R' THEN 'failed'"
    " WHEN l_returnflag = 'A' AND l_suppkey % 10 = 0 THEN ' Settled'"
    " WHEN l_returnflag = 'A' THEN 'settled'"
    " WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'success' END",
    "settlement_date": "CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_shipdate AS STRING) END",
    "account_balance": "c_acctbal",
    "fraud_flag": "l_discount > 0.08",
    "credit_risk": "CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'High'"
    " WHEN o_orderpriority = '3-MEDIUM' THEN 'medium' ELSE 'low ' END",
    "channel": "CASE WHEN l_suppkey % 61 = 0 THEN NULL ELSE CASE l_suppkey % 5 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'web' WHEN 2 THEN 'atm'"
    " WHEN 3 THEN 'branch' ELSE 'POS ' END END",
    "merchant_category": "lower(p_type)",
    "currency": "' usd'",
    "country_code": "CASE WHEN l_suppkey % 59 = 0 THEN NULL WHEN l_suppkey % 67 = 0 THEN ''"
    " WHEN n_regionkey = 1 THEN 'us' ELSE 'x'||CAST(n_nationkey AS STRING) END",
    "ingestion_date": "CAST(l_shipdate AS DATE)",
    "ingestion_time": "l_shipdate",
    "source": f"'{SOURCE_LABEL}'",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze rows from line items, with timestamps that carry no zone.

    Orders get their customer and nation first, and line items their part, so what is
    shuffled by part is as narrow as the table, and the rows leave the last join in order of
    their order, which packs far better than any other. Line items and orders grow together, so
    their join always shuffles and sorts, which can spill and lets adaptive execution split a hot
    order; it also deals the rows of a file with a single row group out to all cores. The other
    sides are broadcast only when their size is below the session's threshold.
    """
    customers = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), on=_equal("c_nationkey", "n_nationkey")
    )
    orders = table(spark, folder, "orders").join(customers, on=_equal("o_custkey", "c_custkey"))
    lines = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "part"), on=_equal("l_partkey", "p_partkey"))
        .join(orders.hint("merge"), on=_equal("l_orderkey", "o_orderkey"))
    )
    return lines.selectExpr(*[f"{EVENT_COLUMNS[name]} AS {name}" for name, _ in BRONZE_FIELDS])


def _equal(left: str, right: str) -> Column:
    return F.col(left) == F.col(right)

"""Values that several test modules share."""

SMALL = "/root/testdata/sf0.001"

TYPICAL = {
    "event_id": "e1",
    "ingest_ts": "2031-06-01T10:00:00.000001",
    "source_system": "core",
    "transaction_id": "TXN1",
    "account_id": "ACCT1",
    "customer_id": "CUST1",
    "txn_date": "2031-05-06T09:10:11",
    "txn_type": "debit",
    "txn_amount": 250.5,
    "txn_status": "settled",
    "settlement_date": "2031-05-07T10:11:12",
    "account_balance": 1000.25,
    "fraud_flag": False,
    "credit_risk": "low",
    "channel": "web",
    "merchant_category": "retail",
    "currency": "USD",
    "country_code": "US",
}


def payload(**changes) -> dict:
    return TYPICAL | changes

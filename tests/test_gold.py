import datetime

import pytest

from tallyrock.operators import kpi
from tallyrock.operators.dims import dim, dim_date
from tallyrock.operators.facts import credit_risk_fact, daily_summary, fraud_fact, lifecycle_fact
from tallyrock.plans.gold import GOLD_TABLES, gold_tables
from tallyrock.plans.silver import silver_increment
from tallyrock.schema import SILVER_FIELDS, names

DAY = datetime.date


@pytest.fixture(scope="module")
def silver(bronze):
    events = [
        {"transaction_id": "t1", "txn_amount": 100.0, "txn_date": "2025-01-08T07:00:00"},
        {"transaction_id": "t2", "txn_amount": 20000.0, "txn_date": "2025-01-08T09:00:00"},
        {"transaction_id": "t3", "txn_amount": 50.5, "txn_status": " Settled", "account_id": "B"},
        {"transaction_id": "t4", "txn_amount": 1.0, "txn_date": "n/a", "country_code": "ca"},
        {"transaction_id": "t5", "txn_amount": 9.5, "txn_status": "failed", "settlement_date": None},
        {"transaction_id": "t5", "txn_amount": 8.5, "at": "2025-03-01 00:00:00"},
        {"transaction_id": "t6", "txn_amount": -1.0},
        {"transaction_id": "t7", "txn_amount": 2.0, "channel": None, "txn_date": "2025-02-03T04:59:59"},
    ]
    dates = {"txn_date": "2025-01-08T12:30:00", "settlement_date": "2025-01-09T20:00:00"}
    return silver_increment(bronze(*[dates | event for event in events])).persist()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_silver_layout(silver):
    assert silver.columns == names(SILVER_FIELDS)
    assert [f"{n} {t.upper()}" for n, t in silver.dtypes] == [f"{n} {t}" for n, t in SILVER_FIELDS]
    assert rows(silver.select("transaction_id")) == [(f"t{i}",) for i in (1, 2, 3, 4, 5, 7)]


def test_lifecycle_takes_the_parsed_times(silver):
    fact = lifecycle_fact(silver.filter("transaction_id = 't1'")).first()
    assert fact.txn_date == datetime.datetime(2025, 1, 8, 7)
    assert fact.settlement_date == datetime.datetime(2025, 1, 9, 20)
    assert lifecycle_fact(silver).count() == silver.count()


def test_fraud_fact_flags_by_rule(silver):
    flags = {r.transaction_id: r.fraud_flag for r in fraud_fact(silver).collect()}
    assert flags == {"t1": 0, "t2": 1, "t3": 0, "t4": 1, "t5": 0, "t7": 1}


@pytest.mark.parametrize("exact", [False, True])
def test_credit_risk(silver, exact):
    found = rows(credit_risk_fact(silver, exact))
    assert found == [
        ("ACCT1", 20112.5, 4022.5, 5, 1, 1 * 2 + 5 * 0.1),
        ("B", 50.5, 50.5, 1, 0, 0.1),
    ]


def test_padded_status_is_not_counted_as_settled(silver):
    days = {r.txn_date_only: r for r in daily_summary(silver).collect()}
    assert set(days) == {DAY(2025, 1, 8), DAY(2025, 2, 3), None}
    first = days[DAY(2025, 1, 8)]
    assert (first.total_txns, first.total_amount, first.settled_txns) == (4, 20160.0, 2)
    assert days[None].total_txns == 1


def test_dimensions_keep_a_null_row(silver):
    assert set(rows(dim(silver, "channel"))) == {("web",), (None,)}
    assert rows(dim_date(silver)) == sorted(
        [(None,) * 5, (DAY(2025, 1, 8), 2025, 1, 8, 2), (DAY(2025, 2, 3), 2025, 2, 3, 6)], key=repr
    )


def test_eleven_tables(silver):
    assert tuple(gold_tables(silver)) == GOLD_TABLES and len(GOLD_TABLES) == 11


def test_measures_agree_with_each_other(silver):
    totals = kpi.totals(silver, exact=True).first()
    assert (totals.total_transactions, totals.total_amount) == (6, 20163.0)
    assert totals.average_amount == pytest.approx(20163.0 / 6)
    for table in (kpi.by_channel(silver, True), kpi.by_merchant(silver, True)):
        found = table.collect()
        assert sum(r.transactions for r in found) == 6
        assert sum(r.amount for r in found) == 20163.0
    days = daily_summary(silver, exact=True).collect()
    assert sum(r.total_amount for r in days) == totals.total_amount
    assert sum(r.txn_count for r in credit_risk_fact(silver).collect()) == 6
    assert sum(r.txn_count for r in kpi.risk_trend(silver).collect()) == 6


def test_status_and_settlement_measures(silver):
    assert rows(kpi.by_status(silver)) == [("failed", 1), ("settled", 5)]
    failed = {r.txn_status: r for r in kpi.settlement_by_status(silver).collect()}["failed"]
    assert tuple(failed) == ("failed", 1, 0, None, None, None)
    assert tuple(kpi.settlement_rate(silver).first()) == (4, 4 / 6)
    assert tuple(kpi.settlement_rate(silver.limit(0)).first()) == (None, None)


def test_fraud_and_high_value_measures(silver):
    assert rows(kpi.by_fraud_flag(fraud_fact(silver), True)) == [(0, 3, 160.0), (1, 3, 20003.0)]
    assert tuple(kpi.high_value_volume(silver).first()) == (1, 20000.0)

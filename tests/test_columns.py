import datetime
import math

import pytest

from tallyrock.sources.star_schema import EVENT_COLUMNS
from tallyrock.functions import average_amount, calendar_parts, flag, is_suspicious, total_amount
from tallyrock.operators.enrich import enrich, normalize


def test_enrich_keeps_rows_and_adds_seven_columns(bronze):
    row = enrich(bronze({})).select(
        "txn_ts", "settlement_ts", "txn_date_only", "txn_hour", "days_to_settle", "is_settled", "high_value_flag"
    ).collect()
    assert [tuple(r) for r in row] == [
        (
            datetime.datetime(2031, 5, 6, 9, 10, 11),
            datetime.datetime(2031, 5, 7, 10, 11, 12),
            datetime.date(2031, 5, 6),
            9,
            1,
            1,
            0,
        )
    ]


# Rows of a published extract: date, amount, status, settlement, days, settled, high value.
@pytest.mark.parametrize(
    "start, amount, status, end, days, settled, high",
    [
        ("2025-01-11T01:22:18.000Z", 2599.83, "success", "2025-01-11T12:22:18.000Z", 0, 0, 0),
        ("2031-05-06T09:10:11.000Z", 250.5, "settled", "2031-05-07T10:11:12.000Z", 1, 1, 0),
        ("2025-02-07T15:15:39.000Z", 1092.41, "settled", "2025-02-10T12:15:39.000Z", 3, 1, 0),
        ("2025-01-28T19:32:52", 546.88, "success", "2025-01-31T12:32:52", 3, 0, 0),
        ("2025-01-10T23:59:59", 5.0, "success", "2025-01-11T00:00:00", 1, 0, 0),
        ("2025-01-10T12:00:00", 5.0, "success", "2025-01-08T13:00:00", -2, 0, 0),
        ("2025-01-10T12:00:00", 5.0, "failed", None, None, 0, 0),
        ("n/a", 5.0, "settled", "2025-01-08T13:00:00", None, 1, 0),
        ("2025-01-10T12:00:00", 10000.0, None, None, None, 0, 0),
        ("2025-01-10T12:00:00", 10000.01, " Settled", None, None, 0, 1),
        ("2025-01-10T12:00:00", math.nan, "SETTLED", None, None, 0, 1),
    ],
)
def test_settlement_columns(bronze, start, amount, status, end, days, settled, high):
    rows = bronze(
        {"txn_date": start, "txn_amount": amount, "txn_status": status, "settlement_date": end}
    )
    row = enrich(rows).select("days_to_settle", "is_settled", "high_value_flag").first()
    assert tuple(row) == (days, settled, high)


def test_unreadable_dates_are_null(bronze):
    row = enrich(bronze({"txn_date": "n/a", "settlement_date": "soon"})).first()
    assert (row.txn_ts, row.settlement_ts, row.txn_date_only, row.txn_hour) == (None,) * 4


def test_normalize_trims_spaces_only(bronze):
    row = normalize(
        bronze(
            {
                "txn_type": " Debit ",
                "txn_status": "SETTLED",
                "channel": "\tPOS ",
                "merchant_category": None,
                "currency": " usd",
                "country_code": "us ",
                "credit_risk": "High",
            }
        )
    ).first()
    assert (row.txn_type, row.txn_status, row.channel, row.merchant_category) == (
        "debit",
        "settled",
        "\tpos",
        None,
    )
    assert (row.currency, row.country_code, row.credit_risk) == ("USD", "US", "high")


@pytest.mark.parametrize(
    "amount, hour, country, expected",
    [
        (5.0, None, "US", 0),
        (5.0, 10, None, 0),
        (5.0, 0, "US", 1),
        (5.0, 4, "US", 1),
        (5.0, 5, "US", 0),
        (5.0, 10, "", 1),
        (5.0, 10, "CA", 1),
        (10000.0, 10, "US", 0),
        (20000.0, None, None, 1),
    ],
)
def test_fraud_rule(spark, amount, hour, country, expected):
    rows = spark.createDataFrame(
        [(amount, hour, country)], "txn_amount DOUBLE, txn_hour INT, country_code STRING"
    )
    assert rows.select(flag(is_suspicious())).first()[0] == expected


def test_week_is_the_iso_week(spark):
    day = spark.sql("SELECT DATE '2024-12-30' AS date")
    assert tuple(day.select(*calendar_parts("date").values()).first()) == (2024, 12, 30, 1)


def amounts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "txn_amount DOUBLE")


def test_exact_total_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9, 0.7] * 200
    exact = total_amount(exact=True)
    forward = amounts(spark, *values).agg(exact).first()[0]
    backward = amounts(spark, *reversed(values)).agg(exact).first()[0]
    assert forward == backward == 200000000260.0


@pytest.mark.parametrize("exact", [False, True])
def test_totals_of_odd_groups(spark, exact):
    def both(*values):
        row = amounts(spark, *values).agg(total_amount(exact=exact), average_amount(exact=exact))
        return tuple(row.first())

    assert both() == (None, None)
    assert both(None) == (None, None)
    assert both(1.5, None, 2.5) == (4.0, 2.0)
    assert both(1.5, math.inf) == (math.inf, math.inf)
    assert all(math.isnan(value) for value in both(1.5, math.nan))


def test_exact_total_fails_rather_than_leaves_out(spark):
    with pytest.raises(Exception, match="too large"):
        amounts(spark, 1.0, 1e20).agg(total_amount(exact=True)).collect()


def test_exact_total_fails_without_ansi_mode_too(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert amounts(spark, 1.0, 2.25).agg(total_amount(exact=True)).first()[0] == 3.25
        with pytest.raises(Exception, match="too large"):
            amounts(spark, 1.0, 1e17).agg(total_amount(exact=True)).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_the_adapter_keeps_long_keys_apart(spark):
    keys = [1, 1234567, 12345678, 123456789, 1234567890, 1234567891, 20000002, 2000000]
    rows = spark.createDataFrame([(k, 1) for k in keys], "o_custkey BIGINT, l_suppkey BIGINT")
    found = rows.selectExpr(*[f"{EVENT_COLUMNS[n]} AS {n}" for n in ("account_id", "customer_id")]).collect()
    assert len({r.account_id for r in found}) == len(keys)
    assert len({r.customer_id for r in found}) == len({k // 2 for k in keys})

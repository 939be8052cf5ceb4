import math

import pytest

from tallyrock.operators.quality import (
    accepted,
    duplicate_groups,
    quality_report,
    quality_rules,
    split_valid,
)

BAD = [
    ({"transaction_id": None}, ["transaction_id_present"]),
    ({"account_id": None}, ["account_id_present"]),
    ({"customer_id": None}, ["customer_id_present"]),
    ({"txn_amount": None}, ["txn_amount_present", "txn_amount_positive"]),
    ({"txn_amount": 0.0}, ["txn_amount_positive"]),
    ({"txn_amount": -5.0}, ["txn_amount_positive"]),
    ({"txn_date": None}, ["txn_date_present"]),
    ({"txn_date": None, "account_id": None}, ["account_id_present", "txn_date_present"]),
]
ODD_BUT_ACCEPTED = [
    {"txn_amount": math.nan},
    {"txn_amount": math.inf},
    {"txn_date": "n/a"},
    {"txn_date": ""},
    {"transaction_id": ""},
    {"settlement_date": None},
]


@pytest.mark.parametrize("changes, reasons", BAD)
def test_bad_rows_are_rejected_with_their_reasons(bronze, changes, reasons):
    good, bad = split_valid(bronze(changes))
    assert good.count() == 0
    assert [row.reject_reasons for row in bad.collect()] == [reasons]


@pytest.mark.parametrize("changes", ODD_BUT_ACCEPTED)
def test_odd_rows_are_accepted(bronze, changes):
    assert accepted(bronze(changes)).count() == 1


@pytest.mark.parametrize(
    "changes, options",
    [
        ({"txn_amount": math.nan}, {"strict_amount": True}),
        ({"txn_amount": math.inf}, {"strict_amount": True}),
        ({"txn_date": "n/a"}, {"strict_dates": True}),
    ],
)
def test_strict_rules(bronze, changes, options):
    rules = quality_rules(**options)
    assert accepted(bronze(changes), rules).count() == 0
    assert accepted(bronze({}), rules).count() == 1


def test_report_counts_each_rule(bronze):
    rows = bronze(*[changes for changes, _ in BAD], {}, *ODD_BUT_ACCEPTED)
    report = quality_report(rows).first().asDict()
    assert report == {
        "total_rows": 15,
        "failed_transaction_id_present": 1,
        "failed_account_id_present": 2,
        "failed_customer_id_present": 1,
        "failed_txn_amount_present": 1,
        "failed_txn_amount_positive": 3,
        "failed_txn_date_present": 2,
        "accepted_rows": 7,
    }
    good, bad = split_valid(rows)
    assert good.count() + bad.count() == report["total_rows"]


def test_duplicates_leave_out_missing_keys(bronze):
    ids = ["a", "a", "a", "b", None, None]
    groups = duplicate_groups(bronze(*[{"transaction_id": i} for i in ids])).collect()
    assert groups == [("a", 3)]

"""The original job's unit cases: one good order, changed in one place each."""
from decimal import Decimal

import pytest

from verity.operators.compare import compare_outputs
from verity.plans.pipeline import clean_and_curate
from verity.schemas import RAW_TRANSACTIONS

GOOD = {"transaction_id": "ord-7", "customer_id": "cu-3", "product_id": "pr-5", "transaction_date": "2025-03-04",
        "amount": "42.10", "quantity": "3", "promo_code": "SPRING", "ingestion_timestamp": "2025-03-04 08:15:00",
        "source_file": "drop-1.csv"}


def curate(spark, *changes, run_id="batch"):
    raw = [tuple((GOOD | c)[f.name] for f in RAW_TRANSACTIONS.fields) for c in changes]
    buyers = spark.sql("SELECT 'cu-3' AS customer_id UNION ALL SELECT 'cu-4'")
    goods = spark.sql("SELECT 'pr-5' AS product_id UNION ALL SELECT 'pr-6'")
    return clean_and_curate(spark.createDataFrame(raw, RAW_TRANSACTIONS), buyers, goods, run_id)


# The change, and what becomes of the row: a rejection's reason, or values
# that the curated row must show.
CASES = {
    "good": ({}, {"amount": Decimal("42.10")}),
    "blank customer": ({"customer_id": ""}, "missing_required_field"),
    "negative amount": ({"amount": "-0.50"}, "invalid_amount"),
    "unreadable date": ({"transaction_date": "soon"}, "invalid_date"),
    "unknown customer": ({"customer_id": "cu-99"}, "orphan_reference"),
    "currency text": ({"amount": "$3,017.25"}, {"amount": Decimal("3017.25")}),
    "no promo code": ({"promo_code": None}, {"promo_code": "NONE", "is_imputed": True}),
}


@pytest.mark.parametrize("name", CASES)
def test_one_row(spark, name):
    change, expected = CASES[name]
    got = curate(spark, change)
    kept, refused = got.curated.collect(), got.rejected.collect()
    counts = got.counts()
    if isinstance(expected, str):
        assert not kept and [r.reject_reason for r in refused] == [expected]
        assert (counts["curated_count"], counts["rejected_count"]) == (0, 1)
    else:
        assert not refused and {k: kept[0][k] for k in expected} == expected
        assert (counts["curated_count"], counts["rejected_count"]) == (1, 0)


COPIES = [{"ingestion_timestamp": "2025-03-04 06:00:00", "source_file": "old.csv"},
          {"ingestion_timestamp": "2025-03-04 21:00:00", "source_file": "new.csv"}]


def test_of_copies_the_latest_stays(spark):
    got = curate(spark, *COPIES)
    assert [r.source_file for r in got.curated.collect()] == ["new.csv"]
    assert got.counts() == {"raw_count": 2, "rejected_count": 0, "curated_count": 1, "duplicates_dropped": 1}


def test_a_second_run_differs_in_nothing_but_its_id(spark):
    rows = [*COPIES, {"transaction_id": "ord-8", "customer_id": "cu-4", "product_id": "pr-6", "amount": "$9.99"}]
    first, second = (curate(spark, *rows, run_id=x).curated.drop("run_id") for x in ("one", "two"))
    assert compare_outputs(first, second).first()["identical"]
    assert first.count() == 2

"""Cases the reference does not test (FIXTURES.md §3 list), through the
composite operator."""
from decimal import Decimal

from verity.plans.pipeline import clean_and_curate
from verity.schemas import RAW_TRANSACTIONS

USUAL = {"transaction_id": "T1", "customer_id": "C1", "product_id": "P1", "transaction_date": "2025-01-15",
         "amount": "100.00", "quantity": "1", "promo_code": "", "ingestion_timestamp": "2025-01-15 10:00:00",
         "source_file": "f.csv"}


def base(**changes):
    return tuple((USUAL | changes)[f.name] for f in RAW_TRANSACTIONS.fields)


def run(spark, rows, run_id="run1"):
    known = [spark.createDataFrame([(f"{p}{i}",) for i in (1, 2)], f"{c} string")
             for p, c in (("C", "customer_id"), ("P", "product_id"))]
    got = clean_and_curate(spark.createDataFrame(rows, RAW_TRANSACTIONS), *known, run_id)
    return got.curated, got.rejected, got.counts()


def reasons(rej):
    return sorted((r["transaction_id"], r["reject_reason"]) for r in rej.collect())


def test_us_date_and_invalid_calendar_dates(spark):
    rows = [base(transaction_date="01/15/2025"), base(transaction_id="T2", transaction_date="2019-13-40"),
            base(transaction_id="T3", transaction_date="1/5/2025")]
    cur, rej, _ = run(spark, rows)
    assert [r["transaction_id"] for r in cur.collect()] == ["T1"]
    assert reasons(rej) == [("T2", "invalid_date"), ("T3", "invalid_date")]


def test_date_bounds_inclusive(spark):
    rows = [base(transaction_id="A", transaction_date="2024-01-01"),
            base(transaction_id="B", transaction_date="2023-12-31"),
            base(transaction_id="C", transaction_date="2026-12-31"),
            base(transaction_id="D", transaction_date="2027-01-01")]
    cur, rej, _ = run(spark, rows)
    assert sorted(r["transaction_id"] for r in cur.collect()) == ["A", "C"]
    assert reasons(rej) == [("B", "invalid_date"), ("D", "invalid_date")]


def test_amount_overflow_and_ceiling(spark):
    rows = [base(transaction_id=f"N{i}", amount="10.00") for i in range(200)]
    rows += [base(transaction_id="BIG", amount="99999999999.00"),
             base(transaction_id="HIGH", amount="31.00"), base(transaction_id="EDGE", amount="30.00")]
    cur, rej, _ = run(spark, rows)
    # p99 over 203 amounts is 10.00, so the ceiling is 30.00 (inclusive).
    assert reasons(rej) == [("BIG", "invalid_amount"), ("HIGH", "invalid_amount")]
    assert "EDGE" in {r["transaction_id"] for r in cur.collect()}


def test_rule_priority_several_failures(spark):
    rows = [base(customer_id="", amount="-1", transaction_date="bad"),
            base(transaction_id="T2", amount="-1", transaction_date="bad", customer_id="C9"),
            base(transaction_id="T3", transaction_date="bad", customer_id="C9")]
    _, rej, _ = run(spark, rows)
    assert reasons(rej) == [("T1", "missing_required_field"), ("T2", "invalid_amount"),
                            ("T3", "invalid_date")]


def test_ids_null_blank_spaces_padded_and_orphan_product(spark):
    rows = [base(customer_id=None), base(transaction_id="T2", customer_id="   "),
            base(transaction_id="T3", customer_id="  C1 "), base(transaction_id="T4", product_id="P9"),
            base(transaction_id=" T5 ")]
    cur, rej, _ = run(spark, rows)
    assert sorted(r["transaction_id"] for r in cur.collect()) == ["T3", "T5"]
    assert reasons(rej) == [("T1", "missing_required_field"), ("T2", "missing_required_field"),
                            ("T4", "orphan_reference")]


def test_literal_none_promo_is_not_imputed(spark):
    cur, _, _ = run(spark, [base(promo_code="NONE")])
    row = cur.first()
    assert row["promo_code"] == "NONE" and row["is_imputed"] is False


def test_null_timestamp_loses_and_ties_are_total(spark):
    rows = [base(ingestion_timestamp=None, source_file="a.csv"),
            base(ingestion_timestamp="2025-01-15 08:00:00", source_file="z.csv"),
            base(transaction_id="T2", amount="5.00", source_file="b.csv"),
            base(transaction_id="T2", amount="4.00", source_file="b.csv")]
    cur, _, counts = run(spark, rows)
    got = {r["transaction_id"]: (r["source_file"], r["amount"]) for r in cur.collect()}
    assert got == {"T1": ("z.csv", Decimal("100.00")), "T2": ("b.csv", Decimal("4.00"))}
    assert counts["duplicates_dropped"] == 2


def test_empty_and_all_invalid(spark):
    cur, rej, counts = run(spark, [])
    assert cur.count() == 0 and rej.count() == 0 and counts["raw_count"] == 0
    cur, rej, counts = run(spark, [base(amount="x"), base(transaction_id="T2", amount="y")])
    assert cur.count() == 0 and counts["rejected_count"] == 2


def test_outputs_carry_exactly_the_ddl_columns(spark):
    from verity import schemas
    cur, rej, _ = run(spark, [base(), base(transaction_id="T2", amount="-1")])
    assert cur.schema == schemas.CURATED_TRANSACTIONS or \
        [(f.name, f.dataType) for f in cur.schema] == \
        [(f.name, f.dataType) for f in schemas.CURATED_TRANSACTIONS]
    assert [(f.name, f.dataType) for f in rej.schema] == \
        [(f.name, f.dataType) for f in schemas.REJECTED_TRANSACTIONS]

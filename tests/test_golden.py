"""Values recorded for the sf0.01 fixture (FIXTURES.md §6), from the
registered queries."""
import pytest

from verity.plans import analytics as A
from verity.registry import QUERIES, _published_products, _run

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def run(spark):
    return _run(spark, SF)


def test_funnel_and_ceiling(spark, run):
    f = QUERIES["funnel"](spark, SF).first()
    assert (f.raw_count, f.rejected_count, f.curated_count, f.duplicates_dropped) == \
        (60000, 5811, 42388, 11801)
    assert QUERIES["amount_ceiling"](spark, SF).first()[0] == 312448.95
    above = run.tagged.where("amount > 312448.95").count()
    assert above == 100


def test_reject_split(spark):
    got = {r.reject_reason: (r.rows_rejected, r.pct_of_all_rejects)
           for r in QUERIES["reject_rate"](spark, SF).collect()}
    assert got == {"invalid_amount": (1849, 31.82), "invalid_date": (715, 12.3),
                   "missing_required_field": (1498, 25.78), "orphan_reference": (1749, 30.1)}


def test_monthly_and_growth(spark):
    rows = QUERIES["mom_growth"](spark, SF).collect()
    assert len(rows) == 83
    assert (rows[0].year, rows[0].month, rows[0].revenue, rows[0].mom_change) == \
        ("1995", "01", 21990869.66, None)
    assert (rows[1].month, rows[1].revenue, round(rows[1].mom_change, 2)) == \
        ("02", 19313793.53, -2677076.13)
    assert QUERIES["monthly_revenue"](spark, SF).first().orders == 394


def test_top_lists(spark, run):
    top = QUERIES["top_products"](spark, SF).collect()
    assert [(r.product_name, r.revenue) for r in top[:2]] == \
        [("red plate", 50773857.10), ("old rod", 47468665.86)]
    c = QUERIES["top_customers"](spark, SF).first()
    assert (c.customer_id, c.lifetime_spend, c.orders) == ("C1378", 3735949.76, 67)
    vol = QUERIES["top_products_by_volume"](spark, SF).collect()
    units = QUERIES["top_products_by_units"](spark, SF).collect()
    assert [(r.product_name, r.transaction_count) for r in vol[:2]] == [("red plate", 958), ("old rod", 902)]
    assert [(r.product_name, r.units_sold) for r in units[:2]] == [("red plate", 23865), ("old rod", 23077)]
    prods = _published_products(spark, SF)
    orders = {r.product_id: r for r in A.top_products(run.curated, prods, None, "orders", by="id").collect()}
    units = {r.product_id: r for r in A.top_products(run.curated, prods, None, "units", by="id").collect()}
    # 39 orders is the most for a single product id; P817 is one of those tied at the top.
    assert max(r.transaction_count for r in orders.values()) == 39
    assert (orders["P817"].product_name, orders["P817"].transaction_count, units["P817"].units_sold) == \
        ("hot anvil", 39, 1069)


def test_average_order_value(spark):
    got = {r.category: (r.avg_order_value, r.orders) for r in QUERIES["avg_order_value"](spark, SF).collect()}
    assert got["ECONOMY"] == (53456.70, 6522)

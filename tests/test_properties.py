"""Order invariance: the pipeline's outputs do not depend on partitioning."""
import math
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from verity.operators.compare import compare_outputs
from verity.plans.pipeline import clean_and_curate
from verity.schemas import RAW_TRANSACTIONS

ids = st.sampled_from(["T1", "T2", "T3", " T4", "", None])
custs = st.sampled_from(["C1", "C2", " C1 ", "C9", "", None])
prods = st.sampled_from(["P1", "P2", "P9", None])
dates = st.sampled_from(["2025-01-15", "01/16/2025", "2019-13-40", "2031-01-01", "bad", None])
amounts = st.one_of(st.sampled_from(["$1,204.50", "0.00", "-3", "N/A", "", None, "99999999999.00"]),
                    st.integers(1, 500_000).map(lambda c: f"{c / 100:.2f}"))
stamps = st.sampled_from(["2025-01-15 09:00:00", "2025-01-15 15:00:00", None])
files = st.sampled_from(["a.csv", "b.csv", None])
row = st.tuples(ids, custs, prods, dates, amounts, st.sampled_from(["1", "2", "x", None]),
                st.sampled_from(["", "SAVE10", None, "NONE"]), stamps, files)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(row, min_size=1, max_size=40), parts=st.integers(2, 7))
def test_outputs_independent_of_partitioning(spark, rows, parts):
    txns = spark.createDataFrame(rows, RAW_TRANSACTIONS)
    customers = spark.createDataFrame([("C1",), ("C2",)], "customer_id string")
    products = spark.createDataFrame([("P1",), ("P2",)], "product_id string")
    a = clean_and_curate(txns, customers, products, "r")
    b = clean_and_curate(txns.repartition(parts), customers, products, "r")
    assert a.ceiling == b.ceiling
    for x, y in ((a.curated, b.curated), (a.rejected, b.rejected)):
        r = compare_outputs(x, y).first()
        assert r.identical, r
    # The ceiling is the exact percentile_disc of all parsed amounts.
    amts = sorted(v["amount"] for v in a.typed.select("amount").collect() if v["amount"] is not None)
    if amts and amts[max(1, math.ceil(0.99 * len(amts))) - 1] != 0:
        n = len(amts)
        k = max(1, math.ceil(0.99 * n))
        while k > 1 and (k - 1) / n >= 0.99:
            k -= 1
        assert a.ceiling == amts[k - 1] * Decimal("3.0")


def _amount_reference(text):
    """The amount rule in plain Python: drop $ , and Java whitespace, require
    -?digits(.digits)?, round half up to cents, NULL beyond decimal(10,2)."""
    import re
    from decimal import ROUND_HALF_UP, InvalidOperation
    if text is None:
        return None
    cleaned = re.sub(r"[$, \t\n\x0b\f\r]", "", text)
    if not re.fullmatch(r"-?[0-9]+(\.[0-9]+)?", cleaned):
        return None
    try:
        v = Decimal(cleaned).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    except InvalidOperation:
        return None
    return v if abs(v) < Decimal("100000000") else None


amount_text = st.one_of(
    st.none(),
    st.text(alphabet="0123456789$,.- \t+eE", max_size=14),
    st.decimals(min_value=-10**9, max_value=10**9, places=3, allow_nan=False).map(str),
    st.integers(-10**12, 10**12).map(lambda i: f"${i:,}"),
)


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(amount_text, min_size=1, max_size=60))
def test_parse_amount_matches_plain_python(spark, values):
    from verity.functions.parsing import parse_amount
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(parse_amount("x")).collect()]
    assert got == [_amount_reference(v) for v in values]


def _date_reference(text):
    """The date rule in plain Python: ISO yyyy-MM-dd first, then US
    MM/dd/yyyy with two-digit month and day; calendar-invalid text is NULL."""
    import datetime as dt
    import re
    if text is None:
        return None
    if re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", text):
        try:
            return dt.datetime.strptime(text, "%Y-%m-%d").date()
        except ValueError:
            pass
    if re.fullmatch(r"[0-9]{2}/[0-9]{2}/[0-9]{4}", text):
        try:
            return dt.datetime.strptime(text, "%m/%d/%Y").date()
        except ValueError:
            pass
    return None


ymd = st.tuples(st.integers(1000, 9999), st.integers(0, 13), st.integers(0, 32))
date_text = st.one_of(
    st.none(),
    ymd.map(lambda t: f"{t[0]:04d}-{t[1]:02d}-{t[2]:02d}"),
    ymd.map(lambda t: f"{t[1]:02d}/{t[2]:02d}/{t[0]:04d}"),
    ymd.map(lambda t: f"{t[1]}/{t[2]}/{t[0]:04d}"),
    st.text(alphabet="0123456789-/ ", max_size=12),
)


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(date_text, min_size=1, max_size=60))
def test_parse_date_matches_plain_python(spark, values):
    from verity.functions.parsing import parse_date
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(parse_date("x")).collect()]
    assert got == [_date_reference(v) for v in values]


small_rows = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 2) | st.none()),
                      max_size=25)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(a=small_rows, b=small_rows)
def test_compare_outputs_equals_except_all_counts(spark, a, b):
    from collections import Counter
    ca, cb = Counter(a), Counter(b)
    want = (len(a), len(b), sum((ca - cb).values()), sum((cb - ca).values()))
    da = spark.createDataFrame(a, "k string, v int")
    db = spark.createDataFrame(b, "k string, v int")
    r = compare_outputs(da, db).first()
    assert (r.rows_a, r.rows_b, r.only_a, r.only_b) == want
    assert r.identical == (want[2] == 0 and want[3] == 0)


dedupe_rows = st.lists(st.tuples(st.sampled_from(["T1", "T2", "T3"]), st.integers(0, 3) | st.none(),
                                 st.sampled_from(["a.csv", "b.csv"]) | st.none(),
                                 st.sampled_from(["x", "y"]) | st.none()), min_size=1, max_size=30)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=dedupe_rows, parts=st.integers(1, 5))
def test_dedupe_survivor_equals_python_order(spark, rows, parts):
    from pyspark.sql import functions as F

    from verity.operators.dedupe import dedupe

    def key(r):  # ts desc nulls last, src asc nulls first, v asc nulls first
        _, ts, src, v = r
        return (ts is None, -(ts or 0), src is not None, src or "", v is not None, v or "")
    want = {}
    for r in sorted(rows, key=key):
        want.setdefault(r[0], r)
    df = spark.createDataFrame(rows, "id string, ts int, src string, v string").repartition(parts)
    out = dedupe(df, ["id"], [F.col("ts").desc_nulls_last(), F.col("src").asc_nulls_first()])
    assert sorted(tuple(r) for r in out.collect()) == sorted(want.values())


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(vals=st.lists(st.integers(-10**6, 10**9), min_size=1, max_size=80),
       p=st.floats(0.0, 1.0), parts=st.integers(1, 6))
def test_exact_percentile_equals_spark_percentile_disc(spark, vals, p, parts):
    from verity.operators.quantile import exact_percentile_disc
    df = spark.createDataFrame([(Decimal(v) / 100,) for v in vals], "x decimal(10,2)").repartition(parts)
    want = df.selectExpr(f"percentile_disc({p!r}) WITHIN GROUP (ORDER BY x)").first()[0]
    got = exact_percentile_disc(df, "x", p)
    assert Decimal(str(got)) == Decimal(str(want))

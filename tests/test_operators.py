"""Table operators: rules, references, quantile, dedupe, compare, profile."""
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from verity.operators import (
    Rule, check_reference, compare_outputs, conform, dedupe, exact_percentile_disc,
    fingerprint, orphans, schema_profile, tag,
)
from verity.operators.quantile import ceiling


def test_rule_priority_and_null_fails(spark):
    df = spark.createDataFrame([(1, False, False), (2, True, False), (3, True, True),
                                (4, None, True)], "id int, a boolean, b boolean")
    out = tag(df, [Rule("a_failed", F.col("a")), Rule("b_failed", F.col("b"))])
    got = {r["id"]: r["reject_reason"] for r in out.collect()}
    assert got == {1: "a_failed", 2: "b_failed", 3: None, 4: "a_failed"}


def test_check_reference_trims_and_never_multiplies(spark):
    fact = spark.createDataFrame([("C1",), ("C9",), (None,), ("C1",)], "customer_id string")
    dim = spark.createDataFrame([(" C1 ",), ("C1",), ("C2",)], "customer_id string")
    for max_rows in (0, 100):  # shuffle join and broadcast join
        out = check_reference(fact, "customer_id", dim, broadcast_max_rows=max_rows)
        assert sorted((r[0] or "", r[1]) for r in out.collect()) == \
            [("", False), ("C1", True), ("C1", True), ("C9", False)]


def test_orphans(spark):
    fact = spark.createDataFrame([(" C9",), ("C9",), ("C1",), ("",), (None,)], "customer_id string")
    dim = spark.createDataFrame([("C1",)], "customer_id string")
    out = orphans(fact, {"customer": ("customer_id", dim, "customer_id")})
    assert [tuple(r) for r in out.collect()] == [("customer", "C9", 2)]


def _disc(vals, p):
    s = sorted(vals)
    n = len(s)
    k = max(1, math.ceil(p * n))
    while k > 1 and (k - 1) / n >= p:
        k -= 1
    while k < n and k / n < p:
        k += 1
    return s[k - 1]


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_exact_percentile_matches_sort(spark, parts):
    rnd = random.Random(parts)
    vals = [Decimal(rnd.randint(-5000, 2_000_000)) / 100 for _ in range(3000)]
    vals += [Decimal("123.45")] * 1500  # a value holding a third of the rows
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x decimal(10,2)").repartition(parts)
    for p in (0.0, 0.01, 0.33, 0.5, 0.99, 1.0):
        assert exact_percentile_disc(df, "x", p, buckets=64) == _disc(vals, p)


def test_exact_percentile_matches_spark_aggregate(spark):
    rnd = random.Random(7)
    df = spark.createDataFrame([(rnd.randint(0, 10**9),) for _ in range(5000)], "x long")
    want = df.selectExpr("percentile_disc(0.99) WITHIN GROUP (ORDER BY x)").first()[0]
    assert exact_percentile_disc(df, "x", 0.99) == want


def test_ceiling_fallback(spark):
    empty = spark.createDataFrame([(None,)], "x decimal(10,2)")
    assert ceiling(empty, "x", 0.99, Decimal("3.0"), Decimal("1000000")) == Decimal("1000000")
    zeros = spark.createDataFrame([(Decimal("0.00"),)], "x decimal(10,2)")
    assert ceiling(zeros, "x", 0.99, Decimal("3.0"), Decimal("1000000")) == Decimal("1000000")
    one = spark.createDataFrame([(Decimal("10.00"),)], "x decimal(10,2)")
    assert ceiling(one, "x", 0.99, Decimal("3.0"), Decimal("1000000")) == Decimal("30.000")


def test_dedupe_total_order_is_partition_invariant(spark):
    rows = [("T1", "2025-01-01 10:00:00", "a.csv", "x"), ("T1", "2025-01-01 10:00:00", "a.csv", "w"),
            ("T1", None, "0.csv", "z"), ("T2", "2025-01-01 09:00:00", None, "y"),
            ("T2", "2025-01-01 09:00:00", "b.csv", "y")]
    df = spark.createDataFrame(rows, "id string, ts string, src string, v string") \
        .withColumn("ts", F.to_timestamp("ts"))
    order = [F.col("ts").desc_nulls_last(), F.col("src").asc_nulls_first()]
    results = set()
    for n in (1, 2, 5):
        out = dedupe(df.repartition(n), ["id"], order)
        results.add(tuple(sorted((r["id"], r["src"], r["v"]) for r in out.collect())))
    assert results == {(("T1", "a.csv", "w"), ("T2", None, "y"))}


@pytest.mark.parametrize("method", ["portable", "xxhash64"])
def test_fingerprint_null_safe_and_unambiguous(spark, method):
    a = spark.createDataFrame([(None, "x")], "a string, b string")
    b = spark.createDataFrame([("x", None)], "a string, b string")
    assert fingerprint(a, method=method).first()["hash_xor"] != fingerprint(b, method=method).first()["hash_xor"]
    c = spark.createDataFrame([("ab", "c")], "a string, b string")
    d = spark.createDataFrame([("a", "bc")], "a string, b string")
    assert fingerprint(c, method=method).first()["hash_xor"] != fingerprint(d, method=method).first()["hash_xor"]


def test_fingerprint_null_safe(spark):
    a = spark.createDataFrame([(None, "x")], "a string, b string")
    b = spark.createDataFrame([("x", None)], "a string, b string")
    assert fingerprint(a).first()["hash_xor"] != fingerprint(b).first()["hash_xor"]
    c = spark.createDataFrame([("1", "2"), ("3", None)], "a string, b string")
    assert fingerprint(c).first() == fingerprint(c.repartition(3).orderBy(F.desc("a"))).first()


def test_compare_outputs(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    r = compare_outputs(a, b).first()
    assert (r.rows_a, r.rows_b, r.only_a, r.only_b, r.identical) == (4, 3, 2, 1, False)
    same = compare_outputs(a, a.repartition(3)).first()
    assert same.identical and same.only_a == 0


def test_conform(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([("5", "2024-02-30", "x")], "q string, d string, extra string")
    schema = T.StructType([T.StructField("q", T.IntegerType()), T.StructField("d", T.DateType())])
    assert tuple(conform(df, schema).first()) == (5, None)
    with pytest.raises(ValueError):
        conform(df.drop("q"), schema)


def test_schema_profile(spark):
    df = spark.createDataFrame([("1", "2025-01-15"), ("1.5", "2025-01-15 10:00:00"), (None, "x")],
                               "a string, b string")
    rows = {r["column_name"]: r.asDict() for r in schema_profile(df).collect()}
    assert rows["a"]["n_bigint"] == 1 and rows["a"]["n_double"] == 2 and rows["a"]["n_null"] == 1
    assert rows["b"]["n_date"] == 1 and rows["b"]["n_timestamp"] == 1


def test_exact_percentile_of_decimals_and_integers(spark):
    rnd = random.Random(11)
    vals = [Decimal(rnd.randint(-10**6, 10**8)) / 100 for _ in range(4000)] + [Decimal("5.00")] * 2000
    df = spark.createDataFrame([(v,) for v in vals], "x decimal(10,2)").repartition(6)
    for p in (0.0, 0.2, 0.5, 0.99, 1.0):
        assert exact_percentile_disc(df, "x", p) == _disc(vals, p)
    ints = spark.createDataFrame([(i * 7 % 1001,) for i in range(3000)], "x long")
    assert exact_percentile_disc(ints, "x", 0.99) == _disc([i * 7 % 1001 for i in range(3000)], 0.99)


def test_ceiling_approx_mode_is_close(spark):
    rnd = random.Random(3)
    vals = [Decimal(rnd.randint(100, 10**7)) / 100 for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in vals], "x decimal(10,2)")
    exact = ceiling(df, "x", 0.99, Decimal("3.0"), Decimal("1000000"))
    approx = ceiling(df, "x", 0.99, Decimal("3.0"), Decimal("1000000"), mode="approx")
    assert exact == _disc(vals, 0.99) * Decimal("3.0")
    # Within the sketch's rank error (1/accuracy of the rows) of the exact value.
    s = sorted(vals)
    k = s.index(_disc(vals, 0.99))
    lo, hi = s[max(0, k - 5)] * 3, s[min(len(s) - 1, k + 5)] * 3
    assert lo <= approx <= hi


def test_ceiling_stat_mode_matches_approx_quantile(spark):
    vals = [Decimal(i) for i in range(1, 1001)]
    df = spark.createDataFrame([(v,) for v in vals], "x decimal(10,2)")
    q = df.approxQuantile("x", [0.99], 0.01)[0]
    assert ceiling(df, "x", 0.99, Decimal("3.0"), Decimal("1000000"), mode="stat") == \
        Decimal(repr(q)) * Decimal("3.0")


def test_fits_broadcast_bounds_rows_and_bytes(spark):
    from verity.operators.references import fits_broadcast
    df = spark.createDataFrame([("x" * 1000,)] * 10, "k string")
    assert fits_broadcast(df, 10)
    assert not fits_broadcast(df, 9)                  # too many rows
    assert not fits_broadcast(df, 10, max_bytes=5000)  # too many bytes

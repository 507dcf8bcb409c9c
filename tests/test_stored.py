"""Stored value counts, digests and per-file profiles against plain versions."""
import csv
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from test_job import txn
from test_release import batches, names
from verity import schemas
from verity.functions.names import clean_name
from verity.operators import digest, histogram
from verity.operators.compare import compare_outputs
from verity.operators.file_profile import file_profile
from verity.operators.quantile import exact_percentile_disc
from verity.plans.job import run_batch
from verity.plans.pipeline import CurationConfig
from verity.sinks.writers import write_partitioned


@pytest.mark.parametrize("p", [0.0, 0.5, 0.99, 1.0])
def test_percentile_of_counts(spark, p):
    rng = random.Random(3)
    values = [Decimal(rng.randrange(-10**6, 10**9)) / 100 for _ in range(500)] + [Decimal("5.00")] * 300 + [None] * 5
    df = spark.createDataFrame([(v,) for v in values], "a decimal(10,2)")
    want = exact_percentile_disc(df, "a", p)
    for buckets in (1 << 18, 37):  # two levels, and many
        found = histogram.percentile_of(histogram.value_counts(df, "a"), p, 10 if buckets > 37 else 10, buckets)
        assert found.first()[0] == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_percentile_of_nothing_and_of_the_widest_values(spark):
    none = spark.createDataFrame([(None,)], "a long")
    assert histogram.percentile_of(histogram.value_counts(none, "a"), 0.5).first()[0] is None
    assert histogram.ceiling_of(histogram.value_counts(none, "a"), 0.5, Decimal(3), Decimal(7)).first()[0] == 7
    wide = spark.createDataFrame([(x,) for x in (-2**63 + 1, -5, 0, 7, 2**63 - 1)], "a long")
    counts = histogram.value_counts(wide, "a")
    assert [int(histogram.percentile_of(counts, p).first()[0]) for p in (0.0, 0.4, 1.0)] == [-2**63 + 1, -5, 2**63 - 1]


def test_counts_stay_exact_when_days_are_replaced(spark, tmpdir_path):
    """After any subset of days is replaced the percentile is that of the rows."""
    rng = random.Random(5)
    days = [f"d{i}" for i in range(6)]
    rows = {d: [(Decimal(rng.randrange(1, 10**5)) / 100, d) for _ in range(rng.randrange(1, 80))] for d in days}
    schema, path = "a decimal(10,2), day string", f"{tmpdir_path}/counts"
    histogram.write_value_counts(spark.createDataFrame([r for d in days for r in rows[d]], schema), path, "a", ("day",))
    for _ in range(2):
        changed = rng.sample(days, 3)
        for d in changed:
            rows[d] = [(Decimal(rng.randrange(1, 10**6)) / 100, d) for _ in range(rng.randrange(1, 80))]
        fresh = spark.createDataFrame([r for d in changed for r in rows[d]], schema)
        histogram.write_value_counts(fresh, path, "a", ("day",))
        whole = spark.createDataFrame([r for d in days for r in rows[d]], schema)
        counts = histogram.read_value_counts(spark, path, ("day",))
        for p in (0.25, 0.99):
            want = whole.agg(F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY a)")).first()[0]
            assert float(histogram.percentile_of(counts, p, 10).first()[0]) == float(want)


def test_ceiling_over_every_run(spark, tmpdir_path):
    db = names("history")
    cfg = CurationConfig(ceiling_scope="history")
    first = [txn(f"A{i}", amount=f"{i}.00") for i in range(1, 11)]
    one, two = batches(tmpdir_path, first, [txn("B1", amount="25.00"), txn("B2", amount="31.00")])
    assert Decimal(run_batch(spark, one, "one", cfg, publish=False, **db)["ceiling"]) == 30
    for _ in range(2):  # the same run again replaces its counts
        counts = run_batch(spark, two, "two", cfg, merge=True, publish=False, **db)
        assert Decimal(counts["ceiling"]) == 93 and counts["rejected_count"] == 0
    with pytest.raises(ValueError, match="ceiling scope"):
        run_batch(spark, one, "one", CurationConfig(ceiling_scope="other"), **db)


# --- digests ------------------------------------------------------------------

DAYS = "k long, v string, y string, d string"


def outputs(spark, root, change):
    rng = random.Random(8)
    rows = [(i, rng.choice(["x", "y", None]), "2025", f"{i % 20:02d}") for i in range(400)] + [(1, "x", "2025", "01")] * 3
    other = change(list(rows))
    frames = []
    for name, data in (("a", rows), ("b", other)):
        df = spark.createDataFrame(data, DAYS)
        write_partitioned(df, f"{root}/{name}", ("y", "d"))
        digest.write_digests(df, f"{root}/{name}.digest", ("y", "d"), ["k", "v", "y", "d"], buckets=8)
        frames.append((spark.read.schema(DAYS).parquet(f"{root}/{name}"),
                       digest.read_digests(spark, f"{root}/{name}.digest", ("y", "d"))))
    return frames


CHANGES = {
    "equal": lambda rows: rows[::-1],
    "one row": lambda rows: [r if r[0] != 45 else (45, "changed", *r[2:]) for r in rows],
    "null swapped": lambda rows: [(r[0], None, *r[2:]) if r[0] == 7 else r for r in rows],
    "moved": lambda rows: [(*r[:3], "30") if r[0] in (8, 9) else r for r in rows],
    "a copy less": lambda rows: rows[:-1],
    "a day gone": lambda rows: [r for r in rows if r[3] != "05"],
    "empty": lambda rows: [],
}


@pytest.mark.parametrize("change", CHANGES)
def test_digest_comparison_equals_the_full_one(spark, tmpdir_path, change):
    (a, da), (b, db) = outputs(spark, tmpdir_path, CHANGES[change])
    cols = ["k", "v", "y", "d"]
    want = compare_outputs(a, b, cols).first()
    for rows in (1_000_000, 0):
        assert digest.compare_by_digest(a, b, da, db, ("y", "d"), cols, 8, broadcast_max_rows=rows).first() == want
    each = digest.compare_by_digest(a, b, da, db, ("y", "d"), cols, 8, each=True).collect()
    assert (sum(r.only_a for r in each), sum(r.only_b for r in each)) == (want.only_a, want.only_b)
    per_day = lambda df: {r.d: r.n for r in df.groupBy("d").agg(F.count("*").alias("n")).collect()}
    na, nb = per_day(a), per_day(b)
    assert all((r.rows_a, r.rows_b) == (na.get(r.d, 0), nb.get(r.d, 0)) for r in each)


def test_equal_days_are_not_read(spark, tmpdir_path):
    """Days whose digests agree need not even be readable."""
    (a, da), (b, db) = outputs(spark, tmpdir_path, CHANGES["one row"])
    for side in "ab":
        for folder, _, files in os.walk(f"{tmpdir_path}/{side}"):
            if "/d=" in folder and not folder.endswith("d=05"):
                for f in files:
                    if f.endswith(".parquet"):
                        with open(os.path.join(folder, f), "wb") as out:
                            out.write(b"not parquet")
    found = digest.compare_by_digest(a, b, da, db, ("y", "d"), ["k", "v", "y", "d"], 8)
    assert tuple(found.first()) == (403, 403, 1, 1, False)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(concat_ws" in plan or "PartitionFilters: [concat_ws" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


# --- S2 by file -----------------------------------------------------------------

def test_file_profile_names_the_departing_files(spark, tmpdir_path):
    declared = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "amount", "day")])
    typed = T.StructType([T.StructField("amount", schemas.MONEY), T.StructField("day", T.DateType())])
    files = {
        "good.csv": (["id", "amount", "day"], [["a", "1.50", "2025-01-02"], ["b", "", "2025-01-03"]]),
        "messy.csv": ([" ID ", "Amount", "Day"], [["c", "7", "2025-01-02"]]),
        "swapped.csv": (["id", "day", "amount"], [["d", "2025-02-01", "3"]]),
        "bad.csv": (["id", "amount", "day"], [["e", "1,5", "2025-02-30"], ["f, g", "2", "2025-03-01"]]),
        "other.csv": (["id", "amount", "new-col"], [["h", "4.5", "9"], ["id", "amount", "new-col"]]),
        "empty.csv": (["id", "amount", "day"], []),
        "short.csv": (["id", "amount", "day"], [["i"]]),
    }
    for name, (header, rows) in files.items():
        with open(f"{tmpdir_path}/{name}", "w", newline="") as f:
            csv.writer(f).writerows([header, *rows])
    open(f"{tmpdir_path}/nothing.csv", "w").close()
    for max_rows in (1_000_000, 0):
        out = file_profile(spark, tmpdir_path, declared, typed, broadcast_max_rows=max_rows).collect()
        got = {(r.file.rsplit("/", 1)[1], r.column_name): r for r in out}
        assert {f for f, _ in got} == set(files)
        departing = {(f, c) for (f, c), r in got.items() if r.departs}
        assert departing == {("swapped.csv", "day"), ("swapped.csv", "amount"), ("bad.csv", "amount"), ("bad.csv", "day"),
                             ("other.csv", "new_col"), ("other.csv", "day")}
        assert len(out) == len(got) == 3 * len(files) + 1
        r = got["good.csv", "amount"]
        assert (r.position, r.n_rows, r.n_null, r.n_bigint, r.n_double, r.n_uncastable) == (1, 2, 1, 0, 1, 0)
        r = got["bad.csv", "id"]
        assert (r.n_rows, r.n_null, r.n_uncastable) == (2, 0, None)
        assert got["bad.csv", "day"].n_uncastable == got["bad.csv", "amount"].n_uncastable == 1
        assert got["other.csv", "day"].position is None and got["other.csv", "amount"].n_rows == 1
        assert (got["empty.csv", "id"].n_rows, got["short.csv", "day"].n_null) == (0, 1)
    for header, _ in files.values():
        for h in header:
            assert any(c == clean_name(h) for _, c in got)


def test_file_profile_of_nothing(spark, tmpdir_path):
    open(f"{tmpdir_path}/nothing.csv", "w").close()
    assert file_profile(spark, tmpdir_path, schemas.RAW_PRODUCTS).collect() == []


# --- U1 through the writers -------------------------------------------------------

def test_rerun_proof(spark, tmpdir_path, monkeypatch):
    from verity.cli import main
    from verity.plans import proof
    one, = batches(tmpdir_path, [txn("T1"), txn("T2", date="2025-01-16"), txn("B1", amount="-1")])
    args = [x for name in ("raw_transactions", "raw_customers", "raw_products", "curated", "rejected", "metrics",
                           "customers", "products") for x in (f"--{name.replace('_', '-')}-path", getattr(one, name))]
    assert main(["rerun-proof", *args, "--run-id", "one"]) == {"curated.transactions": 2, "rejected.transactions": 1}
    honest, runs = proof.run_batch, []

    def drifting(spark, paths, run_id, *args, **kw):
        """A second run that stores another row."""
        runs.append(run_id)
        if len(runs) == 2:
            with open(f"{paths.raw_transactions}/late.csv", "w", newline="") as f:
                csv.writer(f).writerows([schemas.names(schemas.RAW_TRANSACTIONS), txn("T3")])
            for old in [f for f in os.listdir(paths.raw_transactions) if f == "batch.csv"]:
                with open(f"{paths.raw_transactions}/{old}", "w", newline="") as f:
                    csv.writer(f).writerows([schemas.names(schemas.RAW_TRANSACTIONS), txn("T1"), txn("T2", date="2025-01-16")])
        return honest(spark, paths, run_id, *args, **kw)

    monkeypatch.setattr(proof, "run_batch", drifting)
    with pytest.raises(proof.RerunDifference, match="curated.transactions: .*rejected.transactions: 1 buckets differ"):
        proof.rerun_proof(spark, one, "one", register=False, publish=False)

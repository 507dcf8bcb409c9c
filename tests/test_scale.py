"""Steps whose cost must follow the input: sizes of shuffles, staged frames,
reference checks above the broadcast bound, joins of tables that grow together."""
from dataclasses import replace

from pyspark.sql import functions as F

from verity import registry
from verity.operators.references import check_reference
from verity.plans import job, pipeline
from verity.session import session_settings
from verity.sources import fixtures

SF = "/root/testdata/sf0.001"


def test_batch_partitions_follow_the_text(spark):
    """256 MB a partition left days in a few tasks, whose splits each
    wrote a file for every day, and sorts that did not fit."""
    with session_settings(spark, spark__sql__shuffle__partitions="4"):
        assert job.size_batch(spark, 10 ** 6) == 4
        assert job.size_batch(spark, 3 * 1024 ** 3) == 96
        assert job.size_batch(spark, 128 * 1024 ** 3) == 4096
        assert job.size_batch(spark, 512 * 1024 ** 3) == 4096
        assert job.size_batch(spark, 10 * 1024 ** 4) == 40_960


def test_merge_partitions_follow_the_stored_rows(spark, tmpdir_path, monkeypatch):
    """the late batch is small, the rows it is merged with are not."""
    t, c, p = registry.fixture_tables(spark, SF)
    late = registry.late_rows(registry.by_month(t)).limit(20)
    seen, plain = [], job.merge_existing

    def merge_existing(batch, *rest):
        conf = batch.sparkSession.conf
        seen.append((int(conf.get("spark.sql.shuffle.partitions")),
                     conf.get("spark.sql.adaptive.coalescePartitions.enabled")))
        return plain(batch, *rest)
    monkeypatch.setattr(job, "merge_existing", merge_existing)
    paths = []
    for run, rows in (("a", registry.by_month(t)), ("b", late)):
        at = job.BatchPaths.under(f"{tmpdir_path}/{run}", f"{tmpdir_path}/out")
        for df, path in zip((rows, c, p), (at.raw_transactions, at.raw_customers, at.raw_products)):
            registry._land(df, path)
        paths.append(at)
    job.run_batch(spark, paths[0], "a", registry.FIXTURE_CONFIG, register=False)
    monkeypatch.setattr(job, "BATCH_TARGET_BYTES", 64 * 1024)
    batch = -(-4 * job.input_bytes(spark, paths[1].raw_transactions) // (64 * 1024))
    job.run_batch(spark, paths[1], "b", registry.FIXTURE_CONFIG, register=False, merge=True, merge_scope="table")
    assert seen[0][0] > max(batch, 8) and seen[0][1] == "true"


def test_reference_check_above_the_bound_leaves_the_fact_in_place(spark):
    """F2-F4 at 6 GB: with 5 million keys, every fact row was shuffled and
    sorted once for each check."""
    fact = spark.range(2000).select("id", F.when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 11 == 0, F.lit(""))
                                    .when(F.col("id") % 13 == 0, F.lit("gone"))
                                    .otherwise(F.concat(F.lit("C"), F.col("id") % 100)).alias("customer_id"))
    dim = spark.range(100).select(F.concat(F.lit(" C"), F.col("id").cast("string")).alias("customer_id"))
    got = check_reference(fact, "customer_id", dim, flag="ok", broadcast_max_rows=50)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    plain = check_reference(fact, "customer_id", dim, flag="ok", broadcast_max_rows=0)
    rows = {r.id: (r.customer_id, r.ok) for r in got.collect()}
    assert rows == {r.id: (r.customer_id, r.ok) for r in plain.collect()} and len(rows) == 2000
    assert all(ok == (k is not None and k.startswith("C")) for k, ok in rows.values())
    # More unknown keys than the bound: the join of the rows.
    many = check_reference(fact, "customer_id", dim.where("customer_id = ' C1'"), flag="ok", broadcast_max_rows=0)
    few = check_reference(fact, "customer_id", dim.limit(60), flag="ok", broadcast_max_rows=30)
    assert many.where("ok").count() == fact.where("customer_id = 'C1'").count()
    assert few.where("ok").count() == fact.join(dim.limit(60).select(F.trim("customer_id").alias("customer_id")),
                                                "customer_id").count()


def test_checked_rows_are_staged_once_and_not_cached(spark):
    """No query holds the checked rows in
    executor memory or derives them from the raw tables for every pass."""
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    for name in ("flag_amount", "avg_order_value", "rerun_compare", "curated_hard", "rejected_hard", "fingerprint",
                 "run_difference"):
        plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "lineitem" not in plan and "InMemoryTableScan" not in plan and "verity-st" in plan, name
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_ceiling_by_day_reads_the_raw_rows_once(spark, monkeypatch):
    """F16."""
    seen, plain = [], registry.write_value_counts
    monkeypatch.setattr(registry, "write_value_counts",
                        lambda df, *rest: (seen.extend(df.inputFiles()), plain(df, *rest))[1])
    monkeypatch.setattr(registry, "_WRITTEN", {})
    registry.QUERIES["ceiling_by_day"](spark, SF).collect()
    assert seen and all("verity-staged" in f for f in seen)


def test_stored_runs_share_the_raw_rows(spark, monkeypatch):
    """F1 of round 4: the raw rows were derived for each run, and those of the
    first batch staged once more for checks above the bound."""
    want = sorted(map(str, registry.QUERIES["run_difference_by_day"](spark, SF).collect()))
    made, staged = [], []
    by_month, stage_keys = registry.by_month, pipeline.stage_keys
    monkeypatch.setattr(registry, "by_month", lambda raw: (made.append(raw), by_month(raw))[1])
    monkeypatch.setattr(pipeline, "stage_keys", lambda rows, *rest: (staged.append(rows), stage_keys(rows, *rest))[1])
    monkeypatch.setattr(registry, "_WRITTEN", {})
    monkeypatch.setattr(registry, "FIXTURE_CONFIG", replace(registry.FIXTURE_CONFIG, broadcast_max_rows=100))
    got = registry.QUERIES["run_difference_by_day"](spark, f"{SF}/").collect()  # a database of its own
    assert sorted(map(str, got)) == want
    assert len(made) == 1
    assert len(staged) == 2 and all(f.endswith(".csv.gz") for df in staged for f in df.inputFiles())


def test_orders_are_not_broadcast_by_the_fixture(spark, monkeypatch):
    """All: orders grow with lineitem."""
    measured = []
    monkeypatch.setattr(fixtures, "fits_broadcast", lambda df, *rest: bool(measured.append(df.columns)) or True)
    fixtures.raw_transactions(spark, SF)
    assert ["o_orderkey", "o_custkey"] not in measured


def test_tally_equals_merge():
    """op5: the counts of a slice by one plain sort."""
    import numpy as np

    from verity.llm.ctw import merge, tally
    rng = np.random.default_rng(3)
    for n in (0, 1, 5000):
        grams = rng.integers(0, 1 << 56, 700)[rng.integers(0, 700, n)] if n else np.zeros(0, np.int64)
        train = rng.integers(0, 2, n)
        for got, want in zip(tally(grams, train), merge([grams], [train.astype(float)])):
            assert got.dtype == want.dtype == np.int64 and (got == want).all()

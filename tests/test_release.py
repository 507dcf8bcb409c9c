"""Whole-run publication, written partitions, table definitions, the id index
and the rollups, in temp folders."""
import glob
import os

import pytest
from pyspark.sql import functions as F

from test_job import landing, txn
from verity import constants as K
from verity import schemas
from verity.operators import id_index
from verity.plans import analytics as A
from verity.plans import job, rollups
from verity.plans.job import BatchPaths, run_batch
from verity.sinks import catalog, release, writers
from verity.sources.curated import read_curated


def batches(root, *lists):
    """One set of output paths, a raw folder per batch."""
    first = None
    for i, rows in enumerate(lists):
        p = landing(f"{root}/{i}", rows)
        first = first or p
        yield BatchPaths(p.raw_transactions, p.raw_customers, p.raw_products, first.curated, first.rejected,
                         first.metrics, first.customers, first.products)


def names(request):
    return {"curated_db": f"c_{request}", "rejected_db": f"r_{request}"}


def ids(spark, table):
    return sorted((r.transaction_id, r.run_id) for r in spark.table(table).collect())


ONE = [txn("T1"), txn("T2", date="2025-01-16"), txn("B1", amount="-1")]
TWO = [txn("T3", date="2025-01-16"), txn("T1", amount="7.00", ts="2025-01-15 11:00:00"), txn("B2", amount="-1")]


def shown(spark, db):
    return (ids(spark, f"{db['curated_db']}.transactions"), ids(spark, f"{db['rejected_db']}.transactions"),
            sorted(r.run_id for r in spark.table(f"{db['curated_db']}.run_metrics").collect()),
            spark.table(f"{db['curated_db']}.customers").count())


OLD = ([("T1", "one"), ("T2", "one")], [("B1", "one")], ["one"], 2)
NEW = ([("T1", "two"), ("T2", "one"), ("T3", "two")], [("B1", "one"), ("B2", "two")], ["one", "two"], 2)


@pytest.mark.parametrize("failing", ["curated", "record"])
def test_a_failed_write_shows_nothing_of_the_run(spark, tmpdir_path, monkeypatch, failing):
    """The old run is read from every table, whichever write fails."""
    db = names(f"fail_{failing}")
    one, two = batches(tmpdir_path, ONE, TWO)
    run_batch(spark, one, "one", release=True, **db)
    assert shown(spark, db) == OLD
    part, whole, rename = release.Release.write_partitions, release.Release.write_table, release.rename_path

    def partitions(self, df, table, path, *args, **kw):
        out = part(self, df, table, path, *args, **kw)  # written, and then the job dies
        if (failing == "run_metrics" and table.endswith("run_metrics")) or path.endswith(f"{failing}/transactions"):
            raise RuntimeError("lost")
        return out

    def table(self, df, name, path):
        if name.endswith(failing):
            raise RuntimeError("lost")
        whole(self, df, name, path)

    def rename_path(spark, old, new):
        if failing == "record":
            raise RuntimeError("lost")
        rename(spark, old, new)

    with monkeypatch.context() as m:
        m.setattr(release.Release, "write_partitions", partitions)
        m.setattr(release.Release, "write_table", table)
        m.setattr(release, "rename_path", rename_path)
        with pytest.raises(RuntimeError, match="lost"):
            run_batch(spark, two, "two", merge=True, release=True, **db)
    assert shown(spark, db) == OLD
    # What the dead run wrote is gone, and the next attempt succeeds.
    assert all(len(os.listdir(f"{p}.versions")) == 1 for p in (one.curated, one.rejected, one.customers))
    run_batch(spark, two, "two", merge=True, release=True, **db)
    assert shown(spark, db) == NEW


def test_a_committed_run_is_finished_later(spark, tmpdir_path, monkeypatch):
    """A failure between the catalog changes leaves a record; stage 2 (or the
    next run) makes the rest."""
    db = names("later")
    one, two = batches(tmpdir_path, ONE, TWO)
    run_batch(spark, one, "one", release=True, **db)

    def broken(spark, table, *args):
        raise RuntimeError("catalog away")

    with monkeypatch.context() as m:
        m.setattr(release, "set_location", broken)
        with pytest.raises(RuntimeError, match="catalog away"):
            run_batch(spark, two, "two", merge=True, release=True, **db)
    job.publish_catalog(spark, two, **db)
    assert shown(spark, db) == NEW
    assert release.finish_pending(spark, two.releases) == []


def test_release_moves_emptied_days_and_superseded_folders(spark, tmpdir_path):
    db = names("moves")
    later = [txn("T2", date="2025-01-17", ts="2025-01-18 10:00:00")]
    one, two, three = batches(tmpdir_path, ONE, later, [txn("T2", date="2025-01-17", ts="2025-01-19 10:00:00")])
    run_batch(spark, one, "run 'one': 1", release=True, **db)
    run_batch(spark, two, "two", merge=True, merge_scope="table", release=True, **db)
    table = f"{db['curated_db']}.transactions"
    assert sorted((r.transaction_id, r.day) for r in spark.table(table).collect()) == [("T1", "15"), ("T2", "17")]
    assert [p["day"] for p in catalog.partitions(spark, table)] == ["15", "17"]
    assert spark.table(f"{db['rejected_db']}.transactions").where("run_id = \"run 'one': 1\"").count() == 1
    run_batch(spark, three, "three", merge=True, merge_scope="table", release=True, **db)
    gone = release.remove_superseded(spark, three.releases, keep=1)
    assert [g for g in gone if "day=16" in g] and all(not os.path.exists(g.removeprefix("file:")) for g in gone)
    assert sorted((r.transaction_id, r.run_id) for r in spark.table(table).collect()) == [
        ("T1", "run 'one': 1"), ("T2", "three")]
    # A rerun without rejects takes the run's partition back.
    clean = landing(f"{tmpdir_path}/clean", [txn("T1")])
    again = BatchPaths(clean.raw_transactions, clean.raw_customers, clean.raw_products, *[
        getattr(one, n) for n in ("curated", "rejected", "metrics", "customers", "products")])
    run_batch(spark, again, "run 'one': 1", merge=True, release=True, **db)
    assert spark.table(f"{db['rejected_db']}.transactions").count() == 0


def test_a_day_that_left_the_tables_own_path_stays_away(spark, tmpdir_path):
    """The first run was an ordinary one; the second, released, empties one of
    its days. A repair does not bring it back."""
    db = names("own")
    one, two = batches(tmpdir_path, ONE, [txn("T2", date="2025-01-17", ts="2025-01-18 10:00:00")])
    run_batch(spark, one, "one", **db)
    run_batch(spark, two, "two", merge=True, merge_scope="table", release=True, **db)
    job.publish_catalog(spark, two, **db)
    table = f"{db['curated_db']}.transactions"
    assert sorted((r.transaction_id, r.day) for r in spark.table(table).collect()) == [("T1", "15"), ("T2", "17")]
    assert [p["day"] for p in catalog.partitions(spark, table)] == ["15", "17"]


def test_released_tables_refuse_other_runs(spark, tmpdir_path):
    db = names("refuse")
    one, two = batches(tmpdir_path, ONE, TWO)
    run_batch(spark, one, "one", release=True, **db)
    with pytest.raises(ValueError, match="published by releases"):
        run_batch(spark, two, "two", **db)
    with pytest.raises(ValueError, match="catalog"):
        run_batch(spark, two, "two", release=True, register=False)


# --- K7: the written partitions, without a repair --------------------------

def test_a_batch_registers_what_it_wrote(spark, tmpdir_path, monkeypatch):
    db = names("k7")
    one, two, three = batches(tmpdir_path, ONE, TWO, [txn("T3", date="2025-01-18", ts="2025-01-19 00:00:00")])
    run_batch(spark, one, "one", **db)

    def repair(*tables):
        raise AssertionError(f"repair of {tables}")

    with monkeypatch.context() as m:
        m.setattr(job, "repair_partitions", repair)
        m.setattr(catalog, "repair_partitions", repair)
        run_batch(spark, two, "two", merge=True, **db)
        assert shown(spark, db) == NEW
        run_batch(spark, three, "three", merge=True, merge_scope="table", **db)
    table = f"{db['curated_db']}.transactions"
    assert [p["day"] for p in catalog.partitions(spark, table)] == ["15", "16", "18"]
    assert sorted(r.transaction_id for r in spark.table(table).collect()) == ["T1", "T2", "T3"]
    # A table that the catalog does not know yet finds the earlier runs' days.
    run_batch(spark, two, "two", merge=True, merge_scope="table", curated_db="c_k7_other", rejected_db="r_k7_other")
    assert spark.table("c_k7_other.transactions").count() == 3


def test_written_counts_and_partitions(spark, tmpdir_path):
    df = spark.createDataFrame([(i, f"d{i % 3}") for i in range(100)], "x int, day string").repartition(5)
    w = writers.write_partitioned(df, f"{tmpdir_path}/t", ("day",))
    assert (w.rows(), w.partitions()) == (100, [{"day": f"d{i}"} for i in range(3)])
    w = writers.write_partitioned(df.where("x < 0"), f"{tmpdir_path}/t", ("day",))
    assert (w.rows(), w.partitions()) == (0, [])


# --- K6: names that are taken ----------------------------------------------

def test_managed_tables_and_views_keep_what_they_hold(spark, tmpdir_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS taken")
    spark.range(3).write.mode("overwrite").saveAsTable("taken.customers")
    spark.sql("CREATE OR REPLACE VIEW taken.products AS SELECT 1 AS one")
    for name in ("customers", "products"):
        with pytest.raises(ValueError, match="not an external table"):
            catalog.define_table(spark, f"taken.{name}", schemas.CURATED_CUSTOMERS, f"{tmpdir_path}/x")
    assert spark.table("taken.customers").count() == 3 and spark.table("taken.products").first()[0] == 1
    one, = batches(tmpdir_path, ONE)
    with pytest.raises(ValueError, match="not an external table"):
        run_batch(spark, one, "one", curated_db="taken", rejected_db="taken_r")
    assert spark.table("taken.customers").count() == 3
    spark.sql("DROP VIEW taken.products")
    spark.sql("DROP TABLE taken.customers")


# --- B10: the id index ------------------------------------------------------

def test_lookup_reads_the_touched_buckets_only(spark, tmpdir_path):
    table = spark.range(5000).selectExpr("concat('T', id) AS k", "'2025' AS y", "lpad(id % 28 + 1, 2, '0') AS d")
    root = f"{tmpdir_path}/idx"
    id_index.build_index(table, root, "k", ("y", "d"), buckets=64)
    index = id_index.read_index(spark, root, 64)
    asked = spark.createDataFrame([("T7",), ("T7",), ("T4000",), ("none",), (None,)], "k string")
    want = [("T4000", "2025-25"), ("T7", "2025-08")]
    for rows in (1_000_000, 0):  # broadcast, and a join of shuffled sides
        found = id_index.lookup(index, asked, "k", 64, rows)
        assert sorted(map(tuple, found.collect())) == want
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [bucket" in plan and "CartesianProduct" not in plan
    buckets = {r[0] for r in asked.where("k IS NOT NULL").select(id_index.bucket_of("k", 64)).collect()}
    for f in glob.glob(f"{root}/**/*.parquet", recursive=True):  # the other buckets' files need not even be readable
        if int(f.split("bucket=")[1].split("/")[0]) not in buckets:
            with open(f, "wb") as broken:
                broken.write(b"not parquet")
    assert len(buckets) <= 3 and sorted(map(tuple, id_index.lookup(index, asked, "k", 64).collect())) == want
    # A run's rows are added, replaced by the same run, and gone with a rebuild.
    for day in ("30", "31"):
        id_index.add_to_index(spark.createDataFrame([("T7", "2025", day)], "k string, y string, d string"),
                              root, "k", ("y", "d"), "r1", buckets=64)
    assert sorted(r.day for r in id_index.lookup(id_index.read_index(spark, root, 64), asked, "k", 64)
                  .where("id = 'T7'").collect()) == ["2025-08", "2025-31"]
    id_index.build_index(table, root, "k", ("y", "d"), buckets=64)
    assert id_index.read_index(spark, root, 64).count() == 5000


def test_merge_by_id_never_scans_the_tables_ids(spark, tmpdir_path, monkeypatch):
    """An index from the first such merge on; later ones see days it added,
    also through runs that do not merge by id."""
    db = names("idx")
    one, two, three, four = batches(
        tmpdir_path, ONE, [txn("T2", date="2025-01-17", ts="2025-01-18 10:00:00")], [txn("T9", date="2025-02-01")],
        [txn("T9", date="2025-02-02", ts="2025-02-03 00:00:00"), txn("T1", date="2025-02-02", ts="2025-02-03 00:00:00")])
    run_batch(spark, one, "one", **db)
    run_batch(spark, two, "two", merge=True, merge_scope="table", **db)

    def scan(*args, **kw):
        raise AssertionError("the whole table was read for its ids")

    monkeypatch.setattr(job, "build_index", scan)
    run_batch(spark, three, "three", merge=True, **db)
    run_batch(spark, four, "four", merge=True, merge_scope="table", **db)
    rows = sorted((r.transaction_id, r.month, r.day) for r in read_curated(spark, one.curated).collect())
    assert rows == [("T1", "02", "02"), ("T2", "01", "17"), ("T9", "02", "02")]
    assert rows == sorted((r.transaction_id, r.month, r.day) for r in spark.table(f"{db['curated_db']}.transactions").collect())


# --- A4-A11: rollups ---------------------------------------------------------

@pytest.mark.parametrize("released", [False, True])
def test_rollups_follow_merges(spark, tmpdir_path, released):
    db = names(f"roll_{released}")
    many = [txn(f"M{i}", date=f"2025-0{1 + i % 3}-1{i % 9}", amount=f"{10 + i}.25", cust=f"C{1 + i % 2}") for i in range(40)]
    moved = [txn(f"M{i}", date="2025-04-01", amount="5.00", ts="2025-05-01 00:00:00") for i in range(0, 40, 3)]
    moved += [txn("N1", date="2025-01-10")]
    one, two, three = batches(tmpdir_path, many, moved, [txn("M1", date="2025-01-11", ts="2025-06-01 00:00:00")])
    how = {"release": released, **db}
    run_batch(spark, one, "one", **how)  # no rollups yet: the first to ask totals every day
    for i, (p, run) in enumerate(((two, "two"), (three, "three"))):
        run_batch(spark, p, run, merge=True, merge_scope="table", rollups=i == 0, **how)
        facts = spark.table(f"{db['curated_db']}.transactions")
        cust, prod = spark.table(f"{db['curated_db']}.customers"), spark.table(f"{db['curated_db']}.products")
        if released:
            dp, dc = (spark.table(f"{db['curated_db']}.{n}") for n in rollups.ROLLUPS)
        else:
            dp, dc = (rollups.read_rollup(spark, p.daily, n) for n in rollups.ROLLUPS)
        for mine, want in (
                (rollups.monthly_revenue(dp), A.monthly_revenue(facts)), (rollups.mom_growth(dp), A.mom_growth(facts)),
                (rollups.top_products(dp, prod), A.top_products(facts, prod)),
                (rollups.top_products(dp, prod, None, "units", "id"), A.top_products(facts, prod, None, "units", "id")),
                (rollups.top_customers(dc, cust), A.top_customers(facts, cust)),
                (rollups.avg_order_value(dp, prod), A.avg_order_value(facts, prod)),
                (rollups.curated_count(dp), A.curated_count(facts))):
            assert mine.dtypes == want.dtypes
            assert [tuple(r) for r in mine.collect()] == [tuple(r) for r in want.collect()]
            assert "transaction_id" not in mine._jdf.queryExecution().executedPlan().toString()
        assert not [f for f in rollups.top_products(dp, prod).inputFiles() if "/curated/transactions/" in f]
    assert {tuple(r) for r in dp.select(*K.PARTITION_COLUMNS).distinct().collect()} == \
        {tuple(r) for r in facts.select(*K.PARTITION_COLUMNS).distinct().collect()}

"""Writers, catalog, the batch job and the streaming ingest, in temp folders."""
import csv
import glob
import os

import pytest
from pyspark.sql import functions as F

from verity import schemas
from verity.plans.job import BatchPaths, run_batch
from verity.sources.curated import read_curated, read_rejected, read_run_metrics
from verity.sources.raw import drift_report, read_raw_csv

HEADER = [" Transaction ID ", "Customer-Id", "Product ID", "Transaction Date", "Amount",
          "Quantity", "Promo Code", "Ingestion Timestamp", "Source File"]


def write_csv(folder, name, header, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def landing(root, txn_rows, name="batch.csv"):
    write_csv(f"{root}/raw/customers", "c.csv",
              ["customer_id", "customer_name", "email", "region", "signup_date"],
              [["C1", "Ana", "a@x", "north", "2023-01-01"], ["C2", "Beto", "b@x", "south", "2023-02-01"]])
    write_csv(f"{root}/raw/products", "p.csv", ["product_id", "product_name", "category", "unit_price"],
              [["P1", "Widget", "home", "10.0"], ["P2", "Gadget", "electronics", "20.5"]])
    write_csv(f"{root}/raw/transactions", name, HEADER, txn_rows)
    return BatchPaths.under(f"{root}/raw", f"{root}/out")


def txn(tid, date="2025-01-15", amount="100.00", cust="C1", ts="2025-01-15 10:00:00", src="f.csv"):
    return [tid, cust, "P1", date, amount, "1", "", ts, src]


def test_read_raw_csv_maps_messy_headers(spark, tmpdir_path):
    paths = landing(tmpdir_path, [txn("T1")])
    df = read_raw_csv(spark, paths.raw_transactions, schemas.RAW_TRANSACTIONS)
    assert df.columns == schemas.names(schemas.RAW_TRANSACTIONS)
    assert df.first()["transaction_id"] == "T1"


def test_drift_report(spark, tmpdir_path):
    paths = landing(tmpdir_path, [txn("T1")])
    rows = {r["column_name"]: r for r in drift_report(spark, paths.raw_products,
                                                       schemas.CURATED_PRODUCTS).collect()}
    assert rows["unit_price"]["inferred_type"] == "double"
    assert rows["unit_price"]["matches"] is False and rows["product_id"]["matches"] is True


def test_run_batch_rerun_and_catalog(spark, tmpdir_path):
    rows = [txn("T1"), txn("T1", ts="2025-01-15 12:00:00", src="late.csv"), txn("T2", date="01/16/2025"),
            txn("T3", amount="-1"), txn("T4", cust="C9")]
    paths = landing(tmpdir_path, rows)
    c1 = run_batch(spark, paths, "r1")
    assert (c1["raw_count"], c1["rejected_count"], c1["curated_count"]) == (5, 2, 2)
    files = lambda: sorted(os.path.relpath(f, paths.curated).split(os.sep)[:-1]
                           for f in glob.glob(f"{paths.curated}/**/*.parquet", recursive=True))
    files_first = files()
    from verity.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    assert os.path.isdir(os.path.join(root, "verity-staging"))
    assert not os.path.exists(os.path.join(root, "verity-staging", "r1"))  # removed after the writes
    c2 = run_batch(spark, paths, "r1")  # same run again: replaced, not added
    assert (c2["raw_count"], c2["rejected_count"], c2["curated_count"]) == (5, 2, 2)
    assert files() == files_first  # same data files per day folder after the rerun
    cur = read_curated(spark, paths.curated)
    assert cur.count() == 2
    assert sorted(r["source_file"] for r in cur.collect()) == ["f.csv", "late.csv"]
    assert {(r.year, r.month) for r in cur.select("year", "month").collect()} == {("2025", "01")}
    assert read_rejected(spark, paths.rejected).count() == 2
    m = read_run_metrics(spark, paths.metrics).collect()
    assert len(m) == 1 and m[0]["raw_count"] == 5 and m[0]["stage"] == "clean_and_curate"
    # Catalog: both partitioned tables repaired, dimensions published.
    assert spark.table("curated.transactions").count() == 2
    assert spark.table("rejected.transactions").where("run_id = 'r1'").count() == 2
    assert spark.table("curated.transactions").where("month = '01'").count() == 2
    assert spark.table("curated.products").schema["unit_price"].dataType.simpleString() == "decimal(10,2)"
    assert spark.table("curated.customers").count() == 2
    for t in ("curated.transactions", "curated.customers", "curated.products",
              "rejected.transactions", "curated.run_metrics"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_dynamic_overwrite_and_merge(spark, tmpdir_path):
    paths = landing(tmpdir_path, [txn("T1", date="2025-01-15"), txn("T2", date="2025-01-16")])
    run_batch(spark, paths, "a", register=False)
    # Second batch: one more row of 2025-01-16 only.
    later = landing(tmpdir_path + "/b", [txn("T3", date="2025-01-16")])
    later = BatchPaths(later.raw_transactions, later.raw_customers, later.raw_products,
                       paths.curated, paths.rejected, paths.metrics, paths.customers, paths.products)
    run_batch(spark, later, "b", register=False, merge=True)
    ids = sorted(r[0] for r in read_curated(spark, paths.curated).select("transaction_id").collect())
    assert ids == ["T1", "T2", "T3"]
    # Without merge the day holds only the new batch's rows (whole-day replace).
    run_batch(spark, later, "c", register=False)
    ids = sorted(r[0] for r in read_curated(spark, paths.curated).select("transaction_id").collect())
    assert ids == ["T1", "T3"]


def test_streaming_ingest(spark, tmpdir_path):
    from verity.streaming import start_ingest
    paths = landing(tmpdir_path, [txn("T1", date="2025-01-15")], name="b1.csv")
    write_csv(paths.raw_transactions, "b2.csv", schemas.names(schemas.RAW_TRANSACTIONS),
              [txn("T2", date="2025-01-15"), txn("T3", date="2025-01-17")])
    q = start_ingest(spark, paths, f"{tmpdir_path}/ckpt", max_files_per_trigger=1)
    q.awaitTermination(300)
    cur = read_curated(spark, paths.curated)
    assert sorted(r[0] for r in cur.select("transaction_id").collect()) == ["T1", "T2", "T3"]
    runs = {r[0] for r in read_run_metrics(spark, paths.metrics).select("run_id").collect()}
    assert runs == {"stream-0", "stream-1"}
    for t in ("curated.transactions", "curated.customers", "curated.products",
              "rejected.transactions", "curated.run_metrics"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_run_batch_all_rows_rejected(spark, tmpdir_path):
    paths = landing(tmpdir_path, [txn("T1", amount="x"), txn("T2", cust="")])
    c = run_batch(spark, paths, "bad", register=False, materialize="persist")
    assert (c["raw_count"], c["rejected_count"], c["curated_count"]) == (2, 2, 0)
    assert read_rejected(spark, paths.rejected).count() == 2


def test_catalog_sql_matches_dataframe_analytics(spark, tmpdir_path):
    from verity.plans import analytics as A
    from verity.plans.sql import CATALOG_QUERIES, CATALOG_VIEWS, register_views, run_catalog_query
    rows = [txn(f"T{i}", date=f"2025-0{1 + i % 3}-1{i % 9}", amount=f"{10 + i * 3}.50",
                cust=f"C{1 + i % 2}", src=f"s{i % 2}.csv") for i in range(40)]
    rows += [txn("X1", amount="-1"), txn("X2", cust="C9"), txn("X3", date="bad")]
    paths = landing(tmpdir_path, rows)
    run_batch(spark, paths, "sqlrun")
    cur = spark.table("curated.transactions")
    prod, cust = spark.table("curated.products"), spark.table("curated.customers")
    frames = {
        "monthly_revenue": A.monthly_revenue(cur), "mom_growth": A.mom_growth(cur),
        "top_products": A.top_products(cur, prod, 10, "revenue"),
        "top_products_by_volume": A.top_products(cur, prod, 10, "orders"),
        "top_products_by_units": A.top_products(cur, prod, 10, "units"),
        "top_customers": A.top_customers(cur, cust, 20), "avg_order_value": A.avg_order_value(cur, prod),
        "reject_rate": A.reject_rate(spark.table("rejected.transactions")),
        "run_health": A.run_health(spark.table("curated.run_metrics")),
        "curated_count": A.curated_count(cur),
    }
    assert set(frames) == set(CATALOG_QUERIES) | set(CATALOG_VIEWS)
    for name, df in frames.items():
        assert [tuple(r) for r in df.collect()] == \
            [tuple(r) for r in run_catalog_query(spark, name).collect()], name
        plan = run_catalog_query(spark, name)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
    assert "verity_reject_rate" in register_views(spark)
    assert spark.sql("SELECT count(*) FROM verity_monthly_revenue").first()[0] == frames["monthly_revenue"].count()
    # A year filter prunes partitions at the scan.
    plan = A.monthly_revenue(cur, start="2025-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert A.curated_count(cur, start="2025-02-01", end="2025-02-28").first()[0] == \
        cur.where("month = '02'").count()
    for t in ("curated.transactions", "curated.customers", "curated.products",
              "rejected.transactions", "curated.run_metrics"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_csv_landing_matches_registered_outputs(spark, tmpdir_path):
    """The CSV path (S1) loses nothing: a batch landed as text and run
    through run_batch equals the registered fixture outputs."""
    from verity.operators.compare import compare_outputs
    from verity.registry import FIXTURE_CONFIG, QUERIES, fixture_tables
    sf = "/root/testdata/sf0.001"
    paths = BatchPaths.under(f"{tmpdir_path}/raw", f"{tmpdir_path}/out")
    for df, path in zip(fixture_tables(spark, sf), (paths.raw_transactions, paths.raw_customers,
                                                    paths.raw_products)):
        df.select(*[df[c].cast("string") for c in df.columns]).write.option("header", True).csv(path)
    counts = run_batch(spark, paths, "fixture", FIXTURE_CONFIG, register=False)
    want = QUERIES["funnel"](spark, sf).first()
    assert (counts["raw_count"], counts["rejected_count"], counts["curated_count"]) == \
        (want.raw_count, want.rejected_count, want.curated_count)
    cur = read_curated(spark, paths.curated).withColumn("amount", F.col("amount").cast("double"))
    assert compare_outputs(cur, QUERIES["curated"](spark, sf).select(*cur.columns)).first().identical
    # CSV cannot tell an empty field from a NULL one: a blank id lands as
    # NULL. Both are missing values with the same reject reason.
    def blank_as_null(df):
        return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c)
                           for c, t in df.dtypes])
    rej = read_rejected(spark, paths.rejected).withColumn("amount", F.col("amount").cast("double"))
    want_rej = QUERIES["rejected"](spark, sf).select(*rej.columns)
    assert compare_outputs(blank_as_null(rej), blank_as_null(want_rej)).first().identical


def test_cli_runs_the_job(spark, tmpdir_path):
    from verity.cli import main
    paths = landing(tmpdir_path, [txn("T1"), txn("T2", amount="-1")])
    args = []
    for name in ("raw_transactions", "raw_customers", "raw_products", "curated", "rejected",
                 "metrics", "customers", "products"):
        args += [f"--{name.replace('_', '-')}-path", getattr(paths, name)]
    counts = main(["clean-and-curate", *args, "--run-id", "cli-1", "--no-register"])
    assert (counts["raw_count"], counts["rejected_count"], counts["curated_count"]) == (2, 1, 1)
    assert main(["catalog-and-publish", *args]) == {"published": True}
    assert spark.table("rejected.transactions").count() == 1
    for t in ("curated.transactions", "curated.customers", "curated.products",
              "rejected.transactions", "curated.run_metrics"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_large_dimension_keys_are_staged_and_cleaned(spark, tmpdir_path):
    from verity.plans.pipeline import CurationConfig
    from verity.session import ensure_checkpoint_dir
    paths = landing(tmpdir_path, [txn("T1"), txn("T2", cust="C9")])
    cfg = CurationConfig(broadcast_max_rows=1)  # force the shuffle-join path
    c = run_batch(spark, paths, "bigdim", cfg, register=False, publish=False)
    assert (c["raw_count"], c["rejected_count"], c["curated_count"]) == (2, 1, 1)
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    assert not os.path.exists(os.path.join(root, "verity-staging", "bigdim"))


def test_merge_rerun_is_idempotent(spark, tmpdir_path):
    paths = landing(tmpdir_path, [txn("T1"), txn("T2")])
    for _ in range(2):
        run_batch(spark, paths, "m", register=False, publish=False, merge=True)
    ids = sorted(r[0] for r in read_curated(spark, paths.curated).select("transaction_id").collect())
    assert ids == ["T1", "T2"]


def test_merge_table_scope_moves_a_corrected_date(spark, tmpdir_path):
    paths = landing(tmpdir_path, [txn("T1", date="2025-01-15"), txn("T2", date="2025-01-16")])
    run_batch(spark, paths, "a", register=False, publish=False)
    # Later batch: T2's date was corrected to the 17th and ingested later.
    later = landing(tmpdir_path + "/b", [txn("T2", date="2025-01-17", ts="2025-01-18 10:00:00")])
    later = BatchPaths(later.raw_transactions, later.raw_customers, later.raw_products,
                       paths.curated, paths.rejected, paths.metrics, paths.customers, paths.products)
    run_batch(spark, later, "b", register=False, publish=False, merge=True, merge_scope="table")
    rows = sorted((r.transaction_id, r.day) for r in
                  read_curated(spark, paths.curated).select("transaction_id", "day").collect())
    assert rows == [("T1", "15"), ("T2", "17")]
    assert not os.path.exists(os.path.join(paths.curated, "year=2025", "month=01", "day=16"))


def test_shuffle_partitions_sized_from_input(spark, tmpdir_path):
    from verity.session import input_bytes, size_shuffles
    paths = landing(tmpdir_path, [txn("T1")])
    n = input_bytes(spark, paths.raw_transactions)
    assert n and n > 0
    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert size_shuffles(spark, n) == before  # a tiny input never lowers it
    try:
        assert size_shuffles(spark, 10 * 1024 ** 4) == 40_960  # 10 TB / 256 MB
        assert size_shuffles(spark, 10 ** 15) == 3_725_291  # in proportion, however large
        assert size_shuffles(spark, 10 * 1024 ** 4) == 3_725_291  # never lowered
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(before))


def test_read_raw_csv_maps_reordered_headers(spark, tmpdir_path):
    folder = f"{tmpdir_path}/t"
    write_csv(folder, "x.csv", ["Source File", " Amount", "Transaction ID", "customer-id", "Product ID",
                                "Transaction Date", "Quantity", "Promo Code", "Ingestion Timestamp"],
              [["f.csv", "$5.00", "T9", "C1", "P1", "2025-01-15", "2", "", "2025-01-15 10:00:00"]])
    row = read_raw_csv(spark, folder, schemas.RAW_TRANSACTIONS).first()
    assert (row.transaction_id, row.customer_id, row.amount, row.source_file, row.quantity) == \
        ("T9", "C1", "$5.00", "f.csv", "2")


def test_read_raw_csv_rejects_a_file_with_another_column_order(spark, tmpdir_path):
    import pytest
    folder = f"{tmpdir_path}/t"
    cols = schemas.names(schemas.RAW_TRANSACTIONS)
    write_csv(folder, "a.csv", cols, [txn("T1")])
    write_csv(folder, "b.csv", [cols[1], cols[0]] + cols[2:], [txn("T2")])
    with pytest.raises(Exception):
        read_raw_csv(spark, folder, schemas.RAW_TRANSACTIONS).collect()


def test_concurrently_waits_for_all_and_reraises():
    import pytest
    from verity.plans.job import concurrently
    done = []

    def ok():
        done.append(1)

    def bad():
        raise RuntimeError("boom")

    with pytest.raises(RuntimeError, match="boom"):
        concurrently(ok, bad, ok)
    assert done == [1, 1]


def _one_day(amounts, file="d.csv"):
    return [(f"M{file}{i}", "C1", "P1", "2025-01-16", a, "1", "", "2025-01-16 10:00:00", file)
            for i, a in enumerate(amounts)]


def _batch(spark, paths, rows, run_id, **kw):
    from verity.plans.job import run_batch
    from verity.schemas import RAW_CUSTOMERS, RAW_PRODUCTS, RAW_TRANSACTIONS
    text = lambda df, schema: spark.createDataFrame(df, schema)
    wide = lambda key, schema: tuple(key if f.name.endswith("_id") else None for f in schema.fields)
    for df, path in ((text([wide("C1", RAW_CUSTOMERS)], RAW_CUSTOMERS), paths.raw_customers),
                     (text([wide("P1", RAW_PRODUCTS)], RAW_PRODUCTS), paths.raw_products)):
        df.write.mode("overwrite").option("header", True).csv(path)
    return run_batch(spark, paths, run_id, transactions=text(rows, RAW_TRANSACTIONS), register=False, **kw)


def test_unreadable_stored_file_stops_the_merge(spark, tmpdir_path):
    """A stored table that cannot be read is an error, not an empty table: no
    stored row goes."""
    import glob
    from verity.plans.job import BatchPaths
    paths = BatchPaths.under(f"{tmpdir_path}/raw", f"{tmpdir_path}/out")
    _batch(spark, paths, _one_day(["1.00", "2.00"], "a.csv"), "r1")
    day = f"{paths.curated}/year=2025/month=01/day=16"
    with open(f"{day}/broken.parquet", "wb") as f:
        f.write(b"not parquet")
    before = sorted(glob.glob(f"{day}/*.parquet"))
    with pytest.raises(Exception):
        _batch(spark, paths, _one_day(["3.00"], "b.csv"), "r2", merge=True)
    assert sorted(glob.glob(f"{day}/*.parquet")) == before
    root = spark.sparkContext.getCheckpointDir().replace("file:", "")
    assert not glob.glob(f"{root}/verity-staging/*")  # scratch goes after a failure too


def test_rerun_without_rejects_leaves_none(spark, tmpdir_path):
    from verity.plans.job import BatchPaths
    from verity.sources.curated import read_rejected
    paths = BatchPaths.under(f"{tmpdir_path}/raw", f"{tmpdir_path}/out")
    counts = _batch(spark, paths, _one_day(["1.00", "-2.00"]), "run:1 [x]")
    rejected = lambda: read_rejected(spark, paths.rejected).filter("run_id = 'run:1 [x]'").count()
    assert counts["rejected_count"] == rejected() == 1 and counts["duplicates_dropped"] == 0
    assert _batch(spark, paths, _one_day(["1.00", "2.00"]), "run:1 [x]")["rejected_count"] == rejected() == 0


def test_the_callers_time_zone_does_not_matter(spark, tmpdir_path):
    from verity.operators.compare import compare_outputs
    from verity.plans.job import BatchPaths
    from verity.sources.curated import read_curated
    frames = []
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            paths = BatchPaths.under(f"{tmpdir_path}/{name}/raw", f"{tmpdir_path}/{name}/out")
            _batch(spark, paths, _one_day(["1.00", "2.00"]), "r")
            assert spark.conf.get("spark.sql.session.timeZone") == name
            frames.append(read_curated(spark, paths.curated))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert compare_outputs(*frames).first()["identical"]


def test_a_moved_table_answers_from_its_new_place(spark, tmpdir_path):
    from verity.plans.job import BatchPaths, publish_catalog
    for n, amounts in (("one", ["1.00"]), ("two", ["1.00", "2.00", "3.00"])):
        paths = BatchPaths.under(f"{tmpdir_path}/{n}/raw", f"{tmpdir_path}/{n}/out")
        _batch(spark, paths, _one_day(amounts), "r")
        publish_catalog(spark, paths, "moved_curated", "moved_rejected")
        assert spark.table("moved_curated.transactions").count() == len(amounts)


@pytest.mark.parametrize("spelling", ["{}", "file:{}", "file://{}", "{}/"])
def test_publish_refuses_its_own_input(spark, tmpdir_path, spelling):
    from verity.schemas import CURATED_CUSTOMERS, RAW_CUSTOMERS
    from verity.sinks.writers import publish_dimension
    path = f"{tmpdir_path}/dim"
    rows = [tuple("C1" if f.name == "customer_id" else None for f in RAW_CUSTOMERS.fields)]
    spark.createDataFrame(rows, RAW_CUSTOMERS).write.parquet(path)
    with pytest.raises(ValueError):
        publish_dimension(spark.read.parquet(path), CURATED_CUSTOMERS, "customer_id", spelling.format(path))
    assert spark.read.parquet(path).count() == 1


def test_drift_report_lists_undeclared_columns(spark, tmpdir_path):
    from verity.schemas import CURATED_CUSTOMERS
    from verity.sources.raw import drift_report
    spark.createDataFrame([("C1", 5)], "customer_id string, new_col int").write.option("header", True).csv(f"{tmpdir_path}/c")
    rows = {r.column_name: r for r in drift_report(spark, f"{tmpdir_path}/c", CURATED_CUSTOMERS).collect()}
    assert (rows["new_col"].inferred_type, rows["new_col"].declared_type, rows["new_col"].matches) == ("int", None, False)


def test_size_probe_reads_no_rows_in_one_task(spark, monkeypatch):
    """The probe aggregates per map task: no limit gathers rows."""
    from verity.operators import references
    df = spark.range(1000).selectExpr("cast(id as string) AS k").repartition(8)
    plan = df.agg(F.count(F.lit(1)), F.sum(references._value_bytes(df)))._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and references.fits_broadcast(df, 1000) and not references.fits_broadcast(df, 999)


def test_sql_totals_the_facts_before_every_dimension_join(spark, tmpdir_path):
    from verity.plans.job import BatchPaths, publish_catalog
    from verity.plans.sql import CATALOG_QUERIES
    paths = BatchPaths.under(f"{tmpdir_path}/raw", f"{tmpdir_path}/out")
    _batch(spark, paths, _one_day(["1.00"]), "r")
    publish_catalog(spark, paths)
    for name, text in CATALOG_QUERIES.items():
        if " JOIN curated." in text:
            plan = spark.sql(text)._jdf.queryExecution().optimizedPlan().toString()
            join = plan.index("Join Inner")
            assert "Aggregate" in plan[join:], name

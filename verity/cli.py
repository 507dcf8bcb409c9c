"""Job entry point for ``spark-submit``.

    spark-submit verity/cli.py clean-and-curate \\
        --raw-transactions-path /lake/raw/transactions --raw-customers-path ... \\
        --raw-products-path ... --curated-path ... --rejected-path ... \\
        --metrics-path ... --customers-path ... --products-path ... --run-id RUN

    spark-submit verity/cli.py catalog-and-publish --curated-path ... (same paths)

    spark-submit verity/cli.py rerun-proof ... (as clean-and-curate; runs the batch
        twice and fails if the second run left other rows)

The session comes from ``spark-submit`` (cluster settings, checkpoint
folder); this module only parses arguments and calls the library.
"""
from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PATH_ARGS = ("raw_transactions", "raw_customers", "raw_products", "curated", "rejected",
             "metrics", "customers", "products")


def parse(argv: list[str]) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="verity")
    ap.add_argument("command", choices=["clean-and-curate", "catalog-and-publish", "rerun-proof"])
    for a in PATH_ARGS:
        ap.add_argument(f"--{a.replace('_', '-')}-path", required=True)
    ap.add_argument("--run-id")
    ap.add_argument("--min-date")
    ap.add_argument("--max-date")
    ap.add_argument("--ceiling-mode", choices=["exact", "approx", "stat"], default="exact")
    ap.add_argument("--ceiling-scope", choices=["batch", "history"], default="batch",
                    help="history: over the amounts of every run so far")
    ap.add_argument("--merge", action="store_true", help="merge with stored rows of the same days")
    ap.add_argument("--merge-scope", choices=["days", "table"], default="days",
                    help="table: also rewrite days holding older copies of the batch's ids")
    ap.add_argument("--curated-db", default="curated", help="database of the curated tables, in either stage")
    ap.add_argument("--rejected-db", default="rejected", help="database of the rejected table, in either stage")
    ap.add_argument("--table", action="append",
                    help="catalog-and-publish: repair only this partitioned table (repeatable)")
    ap.add_argument("--no-register", action="store_true", help="skip catalog registration")
    ap.add_argument("--release", action="store_true",
                    help="write aside and point the catalog to the run's outputs after the last write")
    ap.add_argument("--rollups", action="store_true", help="keep per-day totals of the curated rows")
    ap.add_argument("--materialize", choices=["staged", "persist"], default="staged",
                    help="staged: checked rows as Parquet under spark.checkpoint.dir")
    return ap.parse_args(argv)


def main(argv: list[str] | None = None) -> dict:
    args = parse(sys.argv[1:] if argv is None else argv)
    from dataclasses import replace

    from pyspark.sql import SparkSession

    from verity.plans.job import BatchPaths, publish_catalog, run_batch
    from verity.plans.pipeline import CurationConfig
    spark = SparkSession.builder.getOrCreate()
    paths = BatchPaths(*[getattr(args, f"{a}_path") for a in PATH_ARGS])
    if args.command == "catalog-and-publish":
        publish_catalog(spark, paths, args.curated_db, args.rejected_db,
                        tuple(args.table) if args.table else None)
        return {"published": True}
    if not args.run_id:
        raise SystemExit(f"--run-id is required for {args.command}")
    config = CurationConfig()
    config = replace(config, min_date=args.min_date or config.min_date,
                     max_date=args.max_date or config.max_date, ceiling_mode=args.ceiling_mode,
                     ceiling_scope=args.ceiling_scope)
    if args.command == "rerun-proof":
        from verity.plans.proof import rerun_proof
        proof = rerun_proof(spark, paths, args.run_id, config, register=False, publish=False,
                            merge=args.merge, merge_scope=args.merge_scope, materialize=args.materialize)
        found = {r.table_name: r.n_rows for r in proof.collect()}
        print(json.dumps(found))
        return found
    counts = run_batch(spark, paths, args.run_id, config, register=not args.no_register,
                       merge=args.merge, merge_scope=args.merge_scope, materialize=args.materialize,
                       release=args.release, rollups=args.rollups, curated_db=args.curated_db,
                       rejected_db=args.rejected_db)
    print(json.dumps(counts))
    return counts


if __name__ == "__main__":
    main()

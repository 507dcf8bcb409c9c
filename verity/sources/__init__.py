"""Scans: raw CSV landing, curated Parquet tables, and the test fixtures."""
from verity.sources.raw import read_raw_csv, infer_schema, drift_report
from verity.sources.curated import (
    read_curated, read_rejected, read_run_metrics, read_dimension,
)
from verity.sources.fixtures import fixture_tables, FIXTURE_MIN_DATE, FIXTURE_MAX_DATE

__all__ = [
    "read_raw_csv", "infer_schema", "drift_report", "read_curated", "read_rejected",
    "read_run_metrics", "read_dimension", "fixture_tables", "FIXTURE_MIN_DATE",
    "FIXTURE_MAX_DATE",
]

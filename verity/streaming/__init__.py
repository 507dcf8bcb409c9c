"""Incremental ingestion of newly landed raw files.

The batch job re-reads the whole landing folder on every run. Here Spark's
file source tracks which files are new, and each micro-batch goes through the
same batch job with ``merge=True`` (a micro-batch may carry part of a day).
``trigger(availableNow=True)`` processes what has landed and stops, which is
how a nightly run uses it.
"""
from verity.streaming.ingest import start_ingest

__all__ = ["start_ingest"]

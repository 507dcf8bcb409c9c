"""verity: retail data-quality pipeline and analytics on Spark.

Subpackages: ``functions`` (Column builders), ``operators`` (table
operators), ``sources`` and ``sinks`` (scans, writers, catalog), ``plans``
(the batch pipeline, the job and the analytics), ``streaming`` (incremental
ingestion). Everything is built from Spark's own expressions.
"""

__version__ = "0.1.0"

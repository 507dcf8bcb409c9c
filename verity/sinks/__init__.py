"""Writers (K1-K5), catalog registration (K6, K7) and publication of whole runs."""
from verity.sinks.writers import (
    configure_dynamic_overwrite, write_curated, write_rejected, write_run_metrics, publish_frame, publish_dimension,
)
from verity.sinks.catalog import add_partitions, create_tables, drop_partitions, repair_partitions
from verity.sinks.release import Release, finish_pending, remove_superseded

__all__ = ["configure_dynamic_overwrite", "write_curated", "write_rejected", "write_run_metrics", "publish_frame",
           "publish_dimension", "add_partitions", "create_tables", "drop_partitions", "repair_partitions", "Release",
           "finish_pending", "remove_superseded"]

"""Table operators: each takes and returns DataFrames (the quantile and
size checks return plain values computed by distributed aggregates)."""
from verity.operators.conform import conform
from verity.operators.rules import Rule, reject_reason, tag, split
from verity.operators.references import distinct_keys, check_reference, orphans, fits_broadcast
from verity.operators.quantile import exact_percentile_disc, approx_percentile, ceiling
from verity.operators.dedupe import dedupe
from verity.operators.compare import fingerprint, compare_outputs
from verity.operators.profile import schema_profile

__all__ = [
    "conform", "Rule", "reject_reason", "tag", "split", "distinct_keys",
    "check_reference", "orphans", "fits_broadcast", "exact_percentile_disc",
    "approx_percentile", "ceiling", "dedupe", "fingerprint", "compare_outputs",
    "schema_profile",
]

"""Composite plans: the clean-and-curate pipeline, the batch job, and the
analytics over the curated tables."""

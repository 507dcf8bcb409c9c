"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage; its registered queries
and their SQL are in ``verity.llm.queries``.
"""

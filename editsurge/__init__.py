"""editsurge: edit-trend analytics expressed as Spark DataFrame jobs.

Edits stream in, get enriched against article tables, are assigned a topic
by walking a class graph, land in an append-only edit table, and are scored
per topic against a daily baseline with a Poisson z-score.  Every operator is
a function from DataFrames to a DataFrame; Catalyst plans the work.
"""

from editsurge.session import get_spark, ensure_checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "ensure_checkpoint_dir"]

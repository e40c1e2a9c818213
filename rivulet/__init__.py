"""rivulet: record enrichment and reshaping as Spark DataFrame operators.

Every operator is a function from DataFrames to DataFrames (or a Column
builder) made of Spark's own expressions, so Catalyst plans it, it runs
distributed, and the stateless ones work unchanged on streaming frames.
"""

from rivulet.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]

"""ledgerlake: a Spark-native payments analytics engine.

Every operator is a function from DataFrames to DataFrames built from Spark SQL / DataFrame
primitives, so Catalyst plans, prunes and pushes down across operator boundaries. Sinks and
streaming runners are thin wrappers around ``DataFrameWriter`` and ``DataStreamWriter``.
"""

from ledgerlake.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]

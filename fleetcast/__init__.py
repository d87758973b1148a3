"""fleetcast: Spark-native feature, matching and monitoring operators.

Every operator is a ``DataFrame -> DataFrame`` function built from public
PySpark DataFrame / SQL / ML / Structured Streaming APIs.  Sources and sinks
are the only functions that take paths.
"""

from fleetcast.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]

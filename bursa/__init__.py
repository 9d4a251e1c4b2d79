"""bursa — a Spark-native equity screening engine.

Exchange feed records (batch or Structured Streaming) are reduced to day views,
rolled into per-symbol statistics and evaluated by criteria screens. Every
operator is a DataFrame/SQL composition that Catalyst plans; no Python UDFs.
"""

from bursa.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]

"""cadenza — a Spark-native engine for audio-feature song catalogs.

Everything is a DataFrame / SQL / ML / Structured Streaming operator; see
"""

from cadenza.session import build_session, checkpoint_dir, ensure_checkpoint_dir

__all__ = ["build_session", "checkpoint_dir", "ensure_checkpoint_dir"]

"""Stream scoring."""

from subscore.streaming.scoring import start_batch_scoring, start_scoring, start_versioned_scoring

__all__ = ["start_batch_scoring", "start_scoring", "start_versioned_scoring"]

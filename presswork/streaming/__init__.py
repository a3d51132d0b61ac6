from presswork.streaming.query import checkpoint_path, start
from presswork.streaming.writer import ScorerNotReady, SinkFailure, batch_writer

__all__ = ["ScorerNotReady", "SinkFailure", "batch_writer", "checkpoint_path", "start"]

"""Streaming entry points. The original jobs are batch only; the one
incremental computation, the daily history merge (O10), can also run as a
Structured Streaming job over newly landed behaviour files."""

from .history import merge_batch, read_history, start

__all__ = ["merge_batch", "read_history", "start"]

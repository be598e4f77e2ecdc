"""Streaming entry points."""

from strata.streaming.batch_stream import batch_files, batch_of_path, run_stream

__all__ = ["batch_files", "batch_of_path", "run_stream"]

"""Structured Streaming driver of the incremental run."""

from constella.streaming.landed import landed_stream, run_stream

__all__ = ["landed_stream", "run_stream"]

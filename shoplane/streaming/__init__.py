"""Structured Streaming trigger for the incremental model refresh."""

from .refresh import source_stream, start_refresh

__all__ = ["source_stream", "start_refresh"]

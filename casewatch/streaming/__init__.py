"""Structured Streaming entry points."""

from casewatch.streaming.landing_stream import load_files, start_landing_stream

__all__ = ["load_files", "start_landing_stream"]

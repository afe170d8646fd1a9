"""Incremental runs of the batch report over a growing statement folder.

The original is a single batch pass with no streaming operators (no watermarks,
windows or state).  This package only drives the same batch plan with
Structured Streaming's file source, so newly arrived statement files are
reported exactly once; no streaming-specific semantics are added.
"""

from .incremental import start_report_stream

__all__ = ["start_report_stream"]

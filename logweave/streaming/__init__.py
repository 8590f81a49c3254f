"""Structured Streaming ingest of a log folder, micro-batch by micro-batch."""

from logweave.streaming.ingest import StreamResult, stream_ingest

__all__ = ["StreamResult", "stream_ingest"]

"""Structured Streaming ingest of raw drops."""

from marquee.streaming.ingest import read_raw_stream, stream_clean

__all__ = ["read_raw_stream", "stream_clean"]

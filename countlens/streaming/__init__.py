"""Structured Streaming form of the count ingest."""

from countlens.streaming.ingest import stream_counts_csv, stream_counts_into

__all__ = ["stream_counts_csv", "stream_counts_into"]

"""File-arrival driven incremental loads (Structured Streaming, availableNow)."""

from .ingest import ingest, landing_stream, stream_checkpoint

__all__ = ["ingest", "landing_stream", "stream_checkpoint"]

"""Structured Streaming forms of the refresh (K1-K3)."""

from orderlens.streaming.refresh import derive_stream, refresh_on_trigger, stream_upsert

__all__ = ["derive_stream", "refresh_on_trigger", "stream_upsert"]

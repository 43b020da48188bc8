"""Incremental ingestion of landed payloads with Structured Streaming."""

from satlink.streaming.landing_stream import start_landing_loads  # noqa: F401

"""Incremental polling as Structured Streaming micro-batches."""

from tidemark.streaming.cdc_stream import start_cdc_stream

__all__ = ["start_cdc_stream"]

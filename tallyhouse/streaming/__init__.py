"""Incremental batches, the layered pipeline, and its Structured Streaming form."""

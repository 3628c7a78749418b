"""Structured Streaming: incremental landing of new raw files."""

"""Incremental landing of detail pages as a Structured Streaming query."""

"""Incremental upkeep of clean tables with Structured Streaming."""

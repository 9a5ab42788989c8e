"""Scans, schema alignment, append sinks, audit log and published tables."""

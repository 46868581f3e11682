"""Sinks: stored tables and batched row delivery to an external service."""

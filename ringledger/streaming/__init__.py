"""Structured Streaming: files that land are ingested once, activity as it arrives."""

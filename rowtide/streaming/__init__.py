"""Structured Streaming sinks and query lifecycle."""

"""Structured Streaming: fan-out of analyses, sinks and metrics."""

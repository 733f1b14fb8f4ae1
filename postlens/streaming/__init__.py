"""Structured Streaming jobs, runners and sinks."""

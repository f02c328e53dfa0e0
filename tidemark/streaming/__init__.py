"""Structured Streaming sources, joins and sinks."""

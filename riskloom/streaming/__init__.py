"""Structured Streaming: replay, scoring, windows and sinks."""

"""Structured Streaming: windowed aggregates, keyed state and sinks."""

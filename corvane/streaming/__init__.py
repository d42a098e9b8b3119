"""Structured Streaming: incremental sync and windowed aggregates."""

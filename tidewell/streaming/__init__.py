"""Structured Streaming: take up new change files as they land."""

"""Structured Streaming: batches of graph rows, and windowed counts of events."""

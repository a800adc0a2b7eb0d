"""Streams: log events in micro-batches, runs as they come."""

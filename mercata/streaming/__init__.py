"""Structured Streaming entry points for batches and raw rows as they arrive."""

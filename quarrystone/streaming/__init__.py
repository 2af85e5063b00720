"""Structured Streaming readers, micro-batches and running totals."""

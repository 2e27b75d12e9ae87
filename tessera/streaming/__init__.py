"""Structured Streaming variants of the batch queries."""

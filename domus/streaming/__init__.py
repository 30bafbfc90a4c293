"""Structured Streaming entry points (micro-batch scoring)."""

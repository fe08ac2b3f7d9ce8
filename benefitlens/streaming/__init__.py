"""Structured Streaming entry points for the row-local scoring path."""

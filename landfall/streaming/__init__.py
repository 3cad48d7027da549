"""Structured Streaming forms of the runs."""

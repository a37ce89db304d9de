"""Structured Streaming forms of the metric queries."""

"""Structured Streaming forms of operators whose input arrives over time."""

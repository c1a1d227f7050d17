"""Structured Streaming forms of the gates, monitors and joins."""

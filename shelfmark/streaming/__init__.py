"""Structured Streaming forms of the status and edit-log operators."""

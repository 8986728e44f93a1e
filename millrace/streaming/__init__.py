"""Structured Streaming forms of the message jobs."""

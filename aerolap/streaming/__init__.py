"""Structured Streaming versions of the jobs."""

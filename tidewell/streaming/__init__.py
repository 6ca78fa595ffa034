"""Structured Streaming paths beside the batch jobs."""

"""Structured Streaming entry into the batch operators."""

"""Structured Streaming front for payment events."""

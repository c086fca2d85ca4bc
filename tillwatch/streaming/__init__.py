"""Structured Streaming forms of the loads and rules."""

"""Structured Streaming forms of the usage, merge and dedupe rules."""

"""Structured Streaming jobs over landed log files."""

"""Scans and writers."""

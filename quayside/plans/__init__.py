"""Whole jobs put together from operators, sources and streams."""

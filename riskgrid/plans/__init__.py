"""Compositions of operators that may stage an intermediate table."""

"""Structured Streaming jobs over any bus-shaped stream."""

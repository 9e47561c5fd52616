"""Structured Streaming twins of the order-sensitive operators, and the micro-batch appliers."""

"""Idempotent table writers, statistics stores and topic output."""

"""Whole jobs, the message fixtures derived from the given tables, and the registered queries."""

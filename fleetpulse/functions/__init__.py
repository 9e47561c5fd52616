"""Column-level building blocks: time buckets, JSON payload fields, text rules, nested maps."""

"""DataFrame-in, DataFrame-out operators. All of them run on batch input."""

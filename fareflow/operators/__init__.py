"""DataFrame in, DataFrame out; no action runs inside."""

"""Column expressions: all built-in, none row-at-a-time."""

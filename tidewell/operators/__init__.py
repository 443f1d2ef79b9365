"""DataFrame operators: change replay, skew-safe lookups, window features."""

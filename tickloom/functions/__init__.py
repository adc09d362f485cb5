"""Column expressions and ordered per-symbol functions."""

"""Column expressions and pure name or path functions."""

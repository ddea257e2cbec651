"""Column expressions and one-row statistics."""

"""Column expressions and row contracts."""

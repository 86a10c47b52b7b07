"""Column expressions: every function takes columns (or names) and returns a column."""

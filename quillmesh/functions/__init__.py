"""Column expressions and page-level functions."""

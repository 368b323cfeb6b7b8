"""Relational operators: merges, selections, reports, page parsing and clustering."""

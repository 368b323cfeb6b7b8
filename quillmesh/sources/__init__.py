"""Readers of sitemaps, robots files, JSON indexes, triples and fetched pages."""

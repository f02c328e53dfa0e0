"""Batch sources: files, catalog tables, literal rows."""

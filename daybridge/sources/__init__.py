"""Scans of tables, landed files and landed API responses."""

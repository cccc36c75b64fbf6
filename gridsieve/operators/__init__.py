"""Operators over requests, catalogs, cells, pixels and files."""

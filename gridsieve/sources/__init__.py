"""Readers: tables, text files, cell tables, tile tables, and file coverage."""

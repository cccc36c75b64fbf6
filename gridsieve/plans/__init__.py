"""Whole requests: extraction of the requested entries and the run report."""

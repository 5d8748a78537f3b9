"""Reusable DataFrame operators: staging, band join, ceiling match, ranking, quality checks."""

"""Whole plans: the combined table, the summary tables, the city report, quality checks."""

"""Column functions: text, dates, results."""

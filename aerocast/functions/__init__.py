"""Column expressions: labels, advice, calendar and parsing."""

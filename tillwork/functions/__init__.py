"""Column expressions: money, dates, text."""

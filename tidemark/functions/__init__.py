"""Column helpers: text, dates, numbers, codes, nested values."""

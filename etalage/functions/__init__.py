"""Column expressions: text, dates, numbers and row rules."""

"""Column expressions: text, numbers, dates and business rules."""

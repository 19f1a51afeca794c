"""Column expressions: calendar, category, measures."""

"""Column expressions: types, conditions, arithmetic, dates and text."""

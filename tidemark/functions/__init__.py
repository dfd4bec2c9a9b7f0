"""Column expressions: time arithmetic, text parsing, JSON fields."""

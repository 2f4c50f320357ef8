"""Column expressions: type decisions, conversions, text forms, naming."""

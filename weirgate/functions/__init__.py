"""Column expressions: marks, JSON values, text forms, verdicts."""

"""Column expressions: carry-over, saturation, calendar and reproducible noise."""

"""Column expressions: parsing raw text, dates, rounding."""

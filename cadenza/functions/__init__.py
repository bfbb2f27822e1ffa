"""Column expressions: text cleaning, schedule parsing and n-grams."""

"""Column expressions: cleaning, time parsing, weights."""

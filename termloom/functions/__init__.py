"""Column expressions: text cleaning, tokens, weights."""

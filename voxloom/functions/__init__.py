"""Column expressions: text cleaning, tokens, names, parameters."""

"""Column expressions: text clean-up, tokenizing, pair building and vector maths."""

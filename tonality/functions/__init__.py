"""Column expressions: labels, tokens, stop words, sentences."""

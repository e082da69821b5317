"""Column expressions: text handling and similarity."""

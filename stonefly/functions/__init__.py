"""Column expressions: null rules, text, dates and keys, numeric helpers."""

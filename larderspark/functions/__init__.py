"""Column expressions: text, numbers, ids, vectors and JSON payloads."""

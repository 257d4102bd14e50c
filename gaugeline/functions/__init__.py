"""Column expressions: parsing, formatting, hashing, ids and payloads."""

"""Column expressions: text, dates, digests, names and event payloads."""

"""Column expressions: type rules, casts and guards, text rules, digests."""

"""Column-level helpers: seeded row hashes, text rules, fixed values."""

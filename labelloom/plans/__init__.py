"""Plan building blocks that keep operators safe on large, skewed tables."""

"""Column expressions: cleaning, features, geometry, scores, hashing."""

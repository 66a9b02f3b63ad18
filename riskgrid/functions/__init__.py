"""Column expressions: location keys, hour numbers, lenient casts, risk levels."""

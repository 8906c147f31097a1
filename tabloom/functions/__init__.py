"""Column expressions: scores, losses, hashed keys, the normal distribution."""

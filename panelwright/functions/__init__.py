"""Column-level building blocks (built-in functions only)."""

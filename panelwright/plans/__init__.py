"""Compositions: conformed models, the fact, and the queries over the given tables."""

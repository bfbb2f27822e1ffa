"""Queries over the driver tables: the operators applied to stand-ins for the two input tables."""

"""Composites: the operators chained in the order a user runs them."""

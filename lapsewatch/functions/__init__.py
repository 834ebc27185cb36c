"""Column-level helpers and exact distribution functions."""

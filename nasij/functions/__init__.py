"""Column functions: pure expressions unless said otherwise."""

"""Queries over the benchmark tables; importing this package registers all of them."""

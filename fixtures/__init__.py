"""Retail star schema derived from the given tables, for queries, tests and benchmarks."""

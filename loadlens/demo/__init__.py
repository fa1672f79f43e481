"""Logistics tables derived from the given TPC-H-like tables, for queries, tests and bench."""

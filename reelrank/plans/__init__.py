"""Composed jobs, the query registry and the reference SQL."""

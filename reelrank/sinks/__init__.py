"""Sinks: publishing tables, post-write checks, answer documents, models."""

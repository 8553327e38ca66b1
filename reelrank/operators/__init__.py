"""Relational operators of the engine, each a function of DataFrames."""

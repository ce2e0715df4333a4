"""Relational building blocks; each takes and returns DataFrames (lazy, no actions unless noted)."""

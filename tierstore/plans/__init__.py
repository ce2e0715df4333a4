"""Composite jobs over a store, and the registry of named queries."""

"""Composite products and the query catalogue."""

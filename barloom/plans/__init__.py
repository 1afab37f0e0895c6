"""Whole flows and the query registry."""

"""Readers, writers and the star-schema view of the sales data."""

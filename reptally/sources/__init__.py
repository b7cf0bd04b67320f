"""Readers, writers and the mapping of the star-schema tables."""

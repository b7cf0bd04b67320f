"""Whole cleaning runs, the query registry and its SQL counterparts."""

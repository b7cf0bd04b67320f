"""Operators, one module per cleaning step."""

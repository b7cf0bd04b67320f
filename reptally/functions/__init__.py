"""Helpers shared by the operators: joins, storage, numerics, bins."""

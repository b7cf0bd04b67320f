"""Rows of a table as sorted tuples; a module of its own, since every folder of tests has a conftest."""


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())

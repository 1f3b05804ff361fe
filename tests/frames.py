"""Rows of DataFrames, for comparisons."""


def rows(df, *order):
    """Collected rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)

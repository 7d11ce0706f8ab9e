"""Helpers that tests import by name."""


def rows(df):
    """The frame's rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)

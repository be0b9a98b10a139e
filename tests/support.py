"""Helpers the tests share (a module of its own: every folder has a ``conftest``)."""


def rows(df, cols=None):
    """Sorted list of tuples of a Spark DataFrame (for order-free comparisons)."""
    cols = cols or df.columns
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: tuple((x is None, str(x)) for x in t))

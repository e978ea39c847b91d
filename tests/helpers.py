"""Helpers of the tests that are no fixtures (a module of its own: every folder's ``conftest`` has the same name)."""


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all when none given)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))

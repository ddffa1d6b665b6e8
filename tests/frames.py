"""Helpers shared by the tests."""


def rows(df, *cols):
    """Collect ``cols`` of ``df`` as a sorted list of tuples."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())

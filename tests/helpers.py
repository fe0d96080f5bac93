"""Small helpers that the test files share."""


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(out, key=repr)

"""Reading results in tests."""


def rows(df, order=None):
    """Collect as plain tuples, sorted for order-insensitive comparison."""
    out = [tuple(r) for r in df.collect()]
    if order is not None:
        return out
    try:
        return sorted(out, key=lambda r: tuple((v is None, 0 if v is None else v) for v in r))
    except TypeError:
        return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))

"""Helpers of the register tests. Not in conftest.py: `tests/llm` has a conftest of
its own, and only one module of that name can be imported."""

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Sorted list of tuples (nulls first) for order-free comparison."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))

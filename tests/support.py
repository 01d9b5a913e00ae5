"""What the test modules share (a module of its own: a ``conftest`` of a
subfolder would hide one of the same name)."""

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, cols=None):
    """Order-insensitive comparable form of a DataFrame."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))

"""Forms of results that the tests compare."""


def rows(df):
    """Result as a set of plain tuples."""
    return {tuple(r) for r in df.collect()}

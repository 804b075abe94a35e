"""Small tables for tests."""

from __future__ import annotations

LABELS = "map<string,string>"


def rows(df, *columns, order=None):
    """Tuples of the columns, in order of the given column or of themselves."""
    got = df.select(*columns, *([order] if order else [])).collect()
    got = sorted(got, key=lambda r: r[-1]) if order else sorted(got, key=lambda r: tuple(str(x) for x in r))
    return [tuple(r)[: len(columns)] for r in got]

"""Names for working columns that no column of a table has."""

from __future__ import annotations

from collections.abc import Iterable


def free(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores added while a column is called so, in whatever case."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name

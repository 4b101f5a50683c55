"""Names for columns of our own beside those of a caller's table."""

from __future__ import annotations

from collections.abc import Iterable


def unused(columns: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, each with as many '_' appended as it takes to differ from every column (in any case)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
